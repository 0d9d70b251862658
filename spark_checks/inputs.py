"""The given tables, and mart sources that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.session import new_path
from starmart.sinks import write_csv


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def point_zero(c: Column) -> Column:
    """A whole number as the text ``n.0``."""
    return F.concat(c.cast("string"), F.lit(".0"))


def sas_days(c: Column) -> Column:
    return F.datediff(c.cast("date"), F.lit("1960-01-01").cast("date"))


def as_csv(df: DataFrame, name: str, sep: str = ",") -> str:
    """Write a derived source as CSV files and return their folder."""
    path = new_path(df.sparkSession, f"source-{name}")
    write_csv(df, path, sep, compressed=True)
    return path


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival records out of lineitem, as text, with repeated keys and missing values."""
    li = table(spark, sf_dir, "lineitem")
    day = sas_days(F.col("l_shipdate"))
    quantity = F.col("l_quantity").cast("int")
    return li.select(
        F.when(
            F.col("l_quantity") != 50, point_zero(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        ).alias("cicid"),
        point_zero(F.year("l_shipdate")).alias("i94yr"),
        point_zero(F.month("l_shipdate")).alias("i94mon"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("i94port"),
        F.nullif(F.concat("l_returnflag", "l_linestatus"), F.lit("AF")).alias("i94addr"),
        F.when(F.col("l_discount") != 0.1, point_zero(day)).alias("arrdate"),
        point_zero(day + quantity).alias("depdate"),
        F.col("l_linenumber").cast("string").alias("i94mode"),
        F.when(F.col("l_tax") != 0.0, point_zero(quantity)).alias("i94visa"),
        point_zero(F.col("l_partkey")).alias("i94cit"),
        point_zero(F.col("l_suppkey")).alias("i94res"),
        point_zero(quantity + 1940).alias("biryear"),
        F.col("l_returnflag").alias("gender"),
        F.when(F.col("l_tax") == 0.08, F.col("l_partkey").cast("string")).alias("insnum"),
        F.col("l_linestatus").alias("airline"),
        F.when(F.col("l_discount") != 0.05, point_zero(F.col("l_partkey") + 50_000_000_000)).alias("admnum"),
        F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("fltno"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("visatype"),
        F.col("l_extendedprice").cast("string").alias("not_used"),
    )


# The same records in SQL, before any cleaning.
ARRIVALS_SQL = """
arrivals as (
  select
    case when l_quantity <> 50 then cast(l_orderkey * 10 + l_linenumber as bigint) end as uid,
    cast(year(l_shipdate) as int) as year,
    cast(month(l_shipdate) as int) as month,
    'S' || l_suppkey as city_code,
    nullif(l_returnflag || l_linestatus, 'AF') as state_code,
    case when l_discount <> 0.1 then cast(l_shipdate as date) end as arrive_date,
    cast(l_shipdate as date) + cast(l_quantity as int) as departure_date,
    cast(l_linenumber as int) as mode,
    case when l_tax <> 0.0 then cast(l_quantity as int) end as visa,
    cast(l_partkey as int) as citizen_country,
    cast(l_suppkey as int) as residence_country,
    cast(l_quantity as int) + 1940 as birth_year,
    l_returnflag as gender,
    case when l_tax = 0.08 then cast(l_partkey as varchar) end as ins_num,
    l_linestatus as airline,
    case when l_discount <> 0.05 then cast(l_partkey + 50000000000 as bigint) end as admission_num,
    lpad(cast(l_suppkey as varchar), 5, '0') as flight_number,
    nullif(l_returnflag, 'R') as visa_type
  from lineitem
)"""


def temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature records out of events: two countries, some texts that are no date."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("value") >= 1.0, F.col("ts").cast("date").cast("string"))
        .otherwise("no date").alias("dt"),
        F.nullif(F.col("value"), F.lit(5.0)).alias("AverageTemperature"),
        F.col("user_id").cast("double").alias("AverageTemperatureUncertainty"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("City"),
        F.when(F.col("user_id") >= 10, "United States").otherwise("Elsewhere").alias("Country"),
        F.lit("1N").alias("Latitude"),
        F.lit("2E").alias("Longitude"),
    )


TEMPERATURES_SQL = """
temperatures as (
  select
    case when value >= 1.0 then strftime(ts, '%Y-%m-%d') else 'no date' end as dt,
    nullif(value, 5.0) as avg_temperature,
    cast(user_id as double) as avg_temperature_uncertainty,
    nullif(event_type, 'error') as city,
    case when user_id >= 10 then 'United States' else 'Elsewhere' end as country
  from events
)"""


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City records out of part, with the column names of the semicolon file."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_brand") != "Brand#1", F.col("p_name")).alias("City"),
        F.initcap(F.col("p_type")).alias("State"),
        (size / 2).alias("Median Age"),
        point_zero(size * 1000).alias("Male Population"),
        point_zero(size * 1100).alias("Female Population"),
        (size * 2100).alias("Total Population"),
        F.when(size != 7, point_zero(size * 10)).alias("Number of Veterans"),
        point_zero(size * 20).alias("Foreign-born"),
        (size / 4).alias("Average Household Size"),
        F.upper(F.substring("p_type", 1, 2)).alias("State Code"),
        F.substring("p_brand", 1, 7).alias("Race"),
        size.alias("Count"),
    )


DEMOGRAPHICS_SQL = """
demographics as (
  select
    case when p_brand <> 'Brand#1' then p_name end as city,
    upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) as state,
    cast(p_size / 2 as double) as median_age,
    cast(p_size * 1000 as int) as male_population,
    cast(p_size * 1100 as int) as female_population,
    case when p_size <> 7 then cast(p_size * 10 as int) end as number_of_veterans,
    cast(p_size * 20 as int) as foreign_born,
    cast(p_size / 4 as double) as average_household_size,
    substr(p_brand, 1, 7) as race
  from part
)"""


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport records out of customer: repeated codes, a quoted value with a comma."""
    key = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.lit("K"), F.floor(F.col("c_custkey") / 3)))
        .alias("ident"),
        F.lower("c_mktsegment").alias("type"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("string").alias("elevation_ft"),
        F.lit(None).cast("string").alias("continent"),
        F.lit("US").alias("iso_country"),
        F.concat(F.lit("US-"), F.col("c_nationkey")).alias("iso_region"),
        F.col("c_name").alias("municipality"),
        key.alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        key.alias("local_code"),
        F.when(
            F.col("c_nationkey") != 3, F.concat(key, F.lit(".5, -"), F.col("c_nationkey"))
        ).alias("coordinates"),
    )


def priced_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temperature series per nation: date, year, month, city, country, avg_temperature."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            F.lower("n_name").alias("city"),
            F.lit("United States").alias("country"),
            # whole numbers add up to the same total in any order
            F.floor("o_totalprice").cast("double").alias("avg_temperature"),
        )
    )


PRICED_PLACES_SQL = """
priced_places as (
  select
    cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
    lower(n_name) as city, 'United States' as country, floor(o_totalprice) as avg_temperature
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
)"""


def arrivals_by_nation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as arrivals (uid, year, month, state_code) and persons (uid, citizen, birth)."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    # customers are unique by key, so this keeps one row per order
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    fact = joined.select(
        F.col("o_orderkey").alias("uid"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("c_nationkey").cast("string").alias("state_code"),
    )
    personal = joined.select(
        F.col("o_orderkey").alias("uid"),
        F.col("c_nationkey").alias("citizen_country"),
        (F.col("c_nationkey") + 1950).alias("birth_year"),
    )
    return fact, personal


def nation_codes(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias(label)
    )
