"""How each table is made from its source, as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..contracts import (
    DIM_AIRPORT, DIM_DEMOGRAPHY, DIM_DEMOGRAPHY_STATS, DIM_IMMIGRATION_AIRLINE,
    DIM_IMMIGRATION_PERSONAL, DIM_TEMPERATURE, FACT_IMMIGRATION, TableContract,
)


@dataclass(frozen=True)
class Recipe:
    """Source columns and cleaning rules of one table.

    ``cleaning`` names the steps in order: ``dedupe`` keeps one row per ``key``,
    ``distinct`` one of equal rows, ``missing`` drops rows without a critical value.
    A de-duplication also removes equal rows, so no ``distinct`` precedes it.
    """

    contract: TableContract
    source: str
    columns: dict[str, str]
    cleaning: tuple[str, ...]
    critical: tuple[str, ...]
    key: tuple[str, ...] = ()
    constants: dict[str, str] = field(default_factory=dict)
    sas_dates: tuple[str, ...] = ()
    late_dates: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    calendar_of: str | None = None
    only: tuple[str, tuple[str, ...]] | None = None

    @property
    def name(self) -> str:
        return self.contract.name


# Source column -> table column, constants, keys and critical columns.
FACT = Recipe(
    FACT_IMMIGRATION, "immigration",
    {
        "cicid": "uid", "i94yr": "year", "i94mon": "month", "i94port": "city_code",
        "i94addr": "state_code", "arrdate": "arrive_date", "depdate": "departure_date",
        "i94mode": "mode", "i94visa": "visa",
    },
    cleaning=("dedupe", "missing"),
    critical=("uid", "arrive_date", "visa"),
    key=("uid",),
    constants={"country": "United States"},
    sas_dates=("arrive_date", "departure_date"),
)

PERSONAL = Recipe(
    DIM_IMMIGRATION_PERSONAL, "immigration",
    {
        "cicid": "uid", "i94cit": "citizen_country", "i94res": "residence_country",
        "biryear": "birth_year", "gender": "gender", "insnum": "ins_num",
    },
    cleaning=("dedupe", "missing"),
    critical=("uid",),
    key=("uid",),
)

AIRLINE = Recipe(
    DIM_IMMIGRATION_AIRLINE, "immigration",
    {
        "cicid": "uid", "airline": "airline", "admnum": "admission_num",
        "fltno": "flight_number", "visatype": "visa_type",
    },
    cleaning=("missing", "dedupe"),
    critical=("uid", "admission_num"),
    key=("uid",),
)

TEMPERATURE = Recipe(
    DIM_TEMPERATURE, "temperature",
    {
        "dt": "date", "AverageTemperature": "avg_temperature",
        "AverageTemperatureUncertainty": "avg_temperature_uncertainty",
        "City": "city", "Country": "country",
    },
    cleaning=("dedupe", "missing"),
    critical=("date", "city"),
    key=("date", "city", "country"),
    late_dates=("date",),
    calendar_of="date",
    only=("country", ("United States",)),
)

DEMOGRAPHY = Recipe(
    DIM_DEMOGRAPHY, "demography",
    {
        "City": "city", "State": "state", "Male Population": "male_population",
        "Female Population": "female_population", "Number of Veterans": "number_of_veterans",
        "Foreign-born": "foreign_born", "Race": "race",
    },
    cleaning=("distinct", "missing"),
    critical=("city", "state"),
)

DEMOGRAPHY_STATS = Recipe(
    DIM_DEMOGRAPHY_STATS, "demography",
    {
        "City": "city", "State": "state", "Median Age": "median_age",
        "Average Household Size": "average_household_size",
    },
    cleaning=("distinct", "missing"),
    critical=("city", "state"),
    upper=("city", "state"),
)

AIRPORT = Recipe(
    DIM_AIRPORT, "airport",
    {
        "ident": "ident", "type": "type", "name": "airport_name", "elevation_ft": "elevation_ft",
        "iso_country": "iso_country", "iso_region": "iso_region", "municipality": "municipality",
        "gps_code": "gps_code", "local_code": "local_code", "coordinates": "coordinates",
    },
    cleaning=("dedupe", "missing"),
    critical=("ident", "coordinates"),
    key=("ident",),
)

RECIPES: dict[str, Recipe] = {
    r.name: r
    for r in (FACT, PERSONAL, AIRLINE, TEMPERATURE, DEMOGRAPHY, DEMOGRAPHY_STATS, AIRPORT)
}
