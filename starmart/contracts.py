"""Table contracts: columns, types, keys and layout of the ten mart tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    normalised: bool = False  # compared as upper(trim()) on both sides

    @property
    def label(self) -> str:
        return f"{','.join(self.columns)}->{self.parent}"


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: StructType
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    id_column: str | None = None
    examples: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def type_of(self, column: str) -> DataType:
        return self.schema[column].dataType


_INT, _LONG, _TEXT = IntegerType(), LongType(), StringType()
_DOUBLE, _DATE = DoubleType(), DateType()


def _contract(name: str, columns: list[tuple], primary_key, **options) -> TableContract:
    fields = [
        StructField(column, dtype, True, {"comment": comment})
        for column, dtype, comment, _ in columns
    ]
    examples = {column: example for column, _, _, example in columns if example is not None}
    key = (primary_key,) if isinstance(primary_key, str) else tuple(primary_key)
    return TableContract(name, StructType(fields), key, examples=examples, **options)


# Names and types of the mart's columns.
FACT_IMMIGRATION = _contract(
    "fact_immigration",
    [
        ("immigration_id", _LONG, "Surrogate id of the arrival", "0"),
        ("uid", _LONG, "Arrival record number", "4084316"),
        ("year", _INT, "Year of arrival", "2016"),
        ("month", _INT, "Month of arrival, 1 to 12", "4"),
        ("city_code", _TEXT, "Code of the port of entry", "SFR"),
        ("state_code", _TEXT, "Code of the state of stay", "CA"),
        ("arrive_date", _DATE, "Day of arrival", "2016-04-29"),
        ("departure_date", _DATE, "Day of departure", "2016-05-04"),
        ("mode", _INT, "Means of travel", "1"),
        ("visa", _INT, "Visa class", "2"),
        ("country", _TEXT, "Country of entry", "United States"),
    ],
    "uid",
    foreign_keys=(
        ForeignKey(("state_code",), "state_code", ("code",)),
        ForeignKey(("city_code",), "city_code", ("code",)),
    ),
    not_null=("uid", "arrive_date", "visa"),
    partition_by=("state_code",),
    id_column="immigration_id",
)

DIM_IMMIGRATION_PERSONAL = _contract(
    "dim_immigration_personal",
    [
        ("immi_personal_id", _LONG, "Surrogate id of the person record", "0"),
        ("uid", _LONG, "Arrival record number", "4084316"),
        ("citizen_country", _INT, "Country code of citizenship", "209"),
        ("residence_country", _INT, "Country code of residence", "209"),
        ("birth_year", _INT, "Year of birth", "1955"),
        ("gender", _TEXT, "Gender as reported", "F"),
        ("ins_num", _TEXT, "Number given by the immigration service", "3943"),
    ],
    "uid",
    foreign_keys=(ForeignKey(("uid",), "fact_immigration", ("uid",)),),
    not_null=("uid",),
    id_column="immi_personal_id",
)

DIM_IMMIGRATION_AIRLINE = _contract(
    "dim_immigration_airline",
    [
        ("immi_airline_id", _LONG, "Surrogate id of the flight record", "0"),
        ("uid", _LONG, "Arrival record number", "4084316"),
        ("airline", _TEXT, "Airline code", "JL"),
        ("admission_num", _LONG, "Admission number", "56582674633"),
        ("flight_number", _TEXT, "Flight number", "00782"),
        ("visa_type", _TEXT, "Class of admission", "WT"),
    ],
    "uid",
    foreign_keys=(ForeignKey(("uid",), "fact_immigration", ("uid",)),),
    not_null=("uid", "admission_num"),
    id_column="immi_airline_id",
)

COUNTRY_CODE = _contract(
    "country_code",
    [
        ("code", _TEXT, "Country code of the arrival records", "101"),
        ("country", _TEXT, "Country name", None),
    ],
    "code",
    not_null=("code",),
)

CITY_CODE = _contract(
    "city_code",
    [
        ("code", _TEXT, "Port code of the arrival records", "SFR"),
        ("city", _TEXT, "City and state of the port", None),
    ],
    "code",
    not_null=("code",),
)

STATE_CODE = _contract(
    "state_code",
    [
        ("code", _TEXT, "State code of the arrival records", "CA"),
        ("state", _TEXT, "State name", None),
    ],
    "code",
    unique=("state",),
    not_null=("code", "state"),
)

DIM_AIRPORT = _contract(
    "dim_airport",
    [
        ("ident", _TEXT, "Airport code", "KSFO"),
        ("type", _TEXT, "Kind and size of the airport", "large_airport"),
        ("airport_name", _TEXT, "Name of the airport", None),
        ("elevation_ft", _INT, "Height above sea level in feet", "13"),
        ("iso_country", _TEXT, "Two-letter country code", "US"),
        ("iso_region", _TEXT, "Country and region code", "US-CA"),
        ("municipality", _TEXT, "Town served", None),
        ("gps_code", _TEXT, "Code used in flight plans", "KSFO"),
        ("local_code", _TEXT, "Code used in the country", "SFO"),
        ("coordinates", _TEXT, "Position as two numbers", "37.6, -122.4"),
    ],
    "ident",
    not_null=("ident", "coordinates"),
)

DIM_TEMPERATURE = _contract(
    "dim_temperature",
    [
        ("date", _DATE, "Day of the measurement", "2013-08-01"),
        ("avg_temperature", _DOUBLE, "Mean temperature", "19.5"),
        ("avg_temperature_uncertainty", _DOUBLE, "Uncertainty of the mean", "0.3"),
        ("city", _TEXT, "City measured", None),
        ("country", _TEXT, "Country of the city", "United States"),
        ("year", _INT, "Year of the date", "2013"),
        ("month", _INT, "Month of the date", "8"),
    ],
    ("date", "city", "country"),
    not_null=("date", "city"),
)

DIM_DEMOGRAPHY = _contract(
    "dim_demography",
    [
        ("demog_pop_id", _LONG, "Surrogate id of the population record", "0"),
        ("city", _TEXT, "City name", None),
        ("state", _TEXT, "State name", None),
        ("male_population", _INT, "Men living there", "40601"),
        ("female_population", _INT, "Women living there", "41862"),
        ("number_of_veterans", _INT, "Veterans living there", "1562"),
        ("foreign_born", _INT, "Residents born abroad", "30908"),
        ("race", _TEXT, "Group the record counts", None),
    ],
    "demog_pop_id",
    not_null=("city", "state"),
    id_column="demog_pop_id",
)

DIM_DEMOGRAPHY_STATS = _contract(
    "dim_demography_stats",
    [
        ("demog_stat_id", _LONG, "Surrogate id of the city record", "0"),
        ("city", _TEXT, "City name in upper case", None),
        ("state", _TEXT, "State name in upper case", None),
        ("median_age", _DOUBLE, "Median age of the residents", "33.8"),
        ("average_household_size", _DOUBLE, "Mean number of people in a household", "2.6"),
    ],
    "demog_stat_id",
    foreign_keys=(
        ForeignKey(("city", "state"), "dim_demography", ("city", "state"), normalised=True),
    ),
    not_null=("city", "state"),
    id_column="demog_stat_id",
)

CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in (
        FACT_IMMIGRATION, DIM_IMMIGRATION_PERSONAL, DIM_IMMIGRATION_AIRLINE,
        COUNTRY_CODE, CITY_CODE, STATE_CODE,
        DIM_TEMPERATURE, DIM_DEMOGRAPHY, DIM_DEMOGRAPHY_STATS, DIM_AIRPORT,
    )
}
