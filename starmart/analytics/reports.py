"""The analyses the mart is for. Each aggregates first and joins what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import upper_trim
from ..operators.joins import code_text, lookup
from ..operators.quantiles import exact_quantiles


def primary_destinations(fact: DataFrame, state_code: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` states with the most arrivals: (state_code, state, n_arrivals)."""
    counted = fact.where(F.col("state_code").isNotNull()).groupBy("state_code").agg(F.count(F.lit(1)).alias("n_arrivals"))
    return (
        lookup(counted, state_code, "state_code", "state", "state")
        .select("state_code", "state", "n_arrivals")
        .orderBy(F.desc("n_arrivals"), F.asc_nulls_last("state_code"))
        .limit(k)
    )


def arrivals_by_month(fact: DataFrame) -> DataFrame:
    """(state_code, year, month, n) of the rows of a fact table."""
    return fact.groupBy("state_code", "year", "month").agg(F.count(F.lit(1)).alias("n"))


def months_after(counted: DataFrame, added: DataFrame, replaced: DataFrame) -> DataFrame:
    """Stored ``arrivals_by_month`` after a batch: less the stored rows it replaced, plus the rows it brought in.

    Reads the batch's rows alone, whatever the table holds. Months left without arrivals go.
    """
    gone = arrivals_by_month(replaced).withColumn("n", -F.col("n"))
    both = counted.unionByName(arrivals_by_month(added)).unionByName(gone)
    return both.groupBy("state_code", "year", "month").agg(F.sum("n").alias("n")).where("n <> 0")


def state_trend(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Arrivals per state and month with the change to the month before, and a trend per state.

    Months without arrivals between a state's first and last one count as 0. Arrivals of an
    unknown month make one row per state, have no change and are not in the slope.
    The second frame holds the slope of a straight line through the months (arrivals
    per month) and its direction. Windows run over one row per state and month.
    """
    return trend_of_months(arrivals_by_month(fact))


def trend_of_months(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As :func:`state_trend`, from stored counts by month."""
    counted = counted.withColumn("period", F.col("year") * 12 + F.col("month") - 1)
    by_state = Window.partitionBy("state_code", F.col("period").isNull()).orderBy("period")
    until = F.coalesce(F.lead("period").over(by_state) - 1, F.col("period"))
    filled = counted.withColumn("until", until).select(
        "state_code", "year", "month", "n", F.col("period").alias("first"),
        F.explode_outer(F.sequence("period", "until")).alias("period"),
    )
    given = F.col("period").isNull() | (F.col("period") == F.col("first"))
    monthly = filled.select(
        "state_code", "period",
        F.when(given, F.col("year")).otherwise(F.floor(F.col("period") / 12).cast("int")).alias("year"),
        F.when(given, F.col("month")).otherwise(F.pmod("period", F.lit(12)) + 1).alias("month"),
        F.when(given, F.col("n")).otherwise(F.lit(0)).alias("n_arrivals"),
    )
    change = F.when(F.col("period").isNotNull(), F.col("n_arrivals") - F.lag("n_arrivals").over(by_state))
    monthly_change = monthly.withColumn("change", change).drop("period")
    slope = F.regr_slope(F.col("n_arrivals").cast("double"), F.col("period").cast("double"))
    trend = (
        monthly.groupBy("state_code")
        .agg(slope.alias("slope"), F.sum("n_arrivals").alias("n_arrivals"))
        .withColumn(
            "direction",
            F.when(F.col("slope") > 0, "increasing").when(F.col("slope") < 0, "decreasing")
            .when(F.col("slope") == 0, "flat"),
        )
    )
    return monthly_change, trend


def age_distribution(fact: DataFrame, personal: DataFrame, band: int = 10) -> DataFrame:
    """Arrivals per age band; the age is the year of arrival less the year of birth."""
    ages = fact.select("uid", "year").join(personal.select("uid", "birth_year"), "uid")
    return age_bands(ages, F.col("year") - F.col("birth_year"), band)


def age_bands(df: DataFrame, age: Column, band: int = 10) -> DataFrame:
    """(age_from, n, share_pct): rows per band of ``band`` years; unknown ages are left out.

    The share is taken over the bands, not the rows.
    """
    counted = (
        df.select((F.floor(age / F.lit(band)) * band).cast("int").alias("age_from"))
        .filter(F.col("age_from").isNotNull())
        .groupBy("age_from").agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("share_pct", F.col("n") * 100.0 / total)


def age_quantiles(df: DataFrame, age: Column, probabilities: list[float]) -> DataFrame:
    """Exact age quantiles, one row, whatever values the ages take."""
    found = exact_quantiles(df.select(age.alias("age")), "age", probabilities)
    return df.sparkSession.createDataFrame([(found,)], "quantiles array<double>")


def climatology(temperature: DataFrame, years: int | None = None) -> DataFrame:
    """Usual temperature of a city in a month, over the last ``years`` years of its record.

    Rows: (city, country, month, avg_temperature, n_days). Later years than the record can
    be approximated by it. The yearly means are formed first, so the last year of a city
    is found among its years and not among its days.
    """
    yearly = temperature.groupBy("city", "country", "year", "month").agg(
        F.sum("avg_temperature").alias("total"), F.count("avg_temperature").alias("n")
    )
    if years is not None:
        known = F.when(F.col("n") > 0, F.col("year"))
        last = F.max(known).over(Window.partitionBy("city", "country"))
        yearly = yearly.withColumn("last", last).filter(F.col("year") > F.col("last") - years)
    return (
        yearly.groupBy("city", "country", "month")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n_days"))
        .select(
            "city", "country", "month",
            F.when(F.col("n_days") > 0, F.col("total") / F.col("n_days")).alias("avg_temperature"),
            "n_days",
        )
    )


def recent_temperatures(temperature: DataFrame, year: int, years: int = 10) -> DataFrame:
    """Approximate temperatures of a year after the record's end, per city and month."""
    return climatology(temperature, years).withColumn("year", F.lit(year))


def warming_by_country(temperature: DataFrame) -> DataFrame:
    """(country_key, year, avg_temperature): mean temperature of a country's year."""
    return (
        temperature.groupBy(upper_trim("country").alias("country_key"), "year")
        .agg(F.avg("avg_temperature").alias("avg_temperature"))
    )


def arrivals_by_origin(fact: DataFrame, personal: DataFrame, country_code: DataFrame) -> DataFrame:
    """(country_key, year, n_arrivals): arrivals by country of citizenship.

    Counted per code before the code's name is looked up.
    """
    counted = (
        fact.select("uid", "year").join(personal.select("uid", "citizen_country"), "uid")
        .groupBy(code_text(personal, "citizen_country").alias("origin"), "year")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        lookup(counted, country_code, "origin", "country", "country")
        .groupBy(upper_trim("country").alias("country_key"), "year")
        .agg(F.sum("n").alias("n_arrivals"))
    )


def warming_and_origins(
    temperature: DataFrame, fact: DataFrame, personal: DataFrame, country_code: DataFrame
) -> DataFrame:
    """Per country of origin: correlation of yearly temperature and arrivals, and warming per year.

    Needs the temperatures of all countries. Where the years of the two records do
    not meet, ``n_years`` counts only the common ones.
    """
    return correlate(
        warming_by_country(temperature), arrivals_by_origin(fact, personal, country_code),
        ["country_key", "year"],
    )


def correlate(warming: DataFrame, arrivals: DataFrame, on: list[str]) -> DataFrame:
    group, period = on
    return (
        warming.join(arrivals, on)
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n_years"),
            F.corr("avg_temperature", F.col("n_arrivals").cast("double")).alias("correlation"),
            F.regr_slope("avg_temperature", F.col(period).cast("double")).alias("warming_per_year"),
        )
    )
