"""Joins of the star schema and the analyses over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart import analytics as an, operators as op
from starmart.session import new_path
from starmart.sinks import write_bucketed

from .inputs import PRICED_PLACES_SQL, arrivals_by_nation, nation_codes, priced_places, table


def destinations_topk(spark, sf_dir) -> DataFrame:
    fact = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("state_code")
    )
    return an.primary_destinations(fact, nation_codes(spark, sf_dir, "state"))


def destinations_of_orders(spark, sf_dir) -> DataFrame:
    """The flagship query: the nations most orders come from."""
    fact, _ = arrivals_by_nation(spark, sf_dir)
    return an.primary_destinations(fact, nation_codes(spark, sf_dir, "state"))


def bucketed_join(spark, sf_dir) -> DataFrame:
    """Fact and person tables in buckets of the same key, joined where they lie."""
    fact, personal = arrivals_by_nation(spark, sf_dir)
    for name, df in (("bucketed_fact", fact), ("bucketed_personal", personal)):
        spark.sql(f"drop table if exists {name}")
        write_bucketed(df, name, new_path(spark, name), ["uid"], 8)
    return op.join_on_uid(spark.table("bucketed_fact"), spark.table("bucketed_personal"))


def enrich_codes(spark, sf_dir) -> DataFrame:
    personal = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("uid"), F.col("c_nationkey").alias("citizen_country"),
        F.concat(F.col("c_nationkey") + 5, F.lit(".0")).alias("residence_country"),
    )
    return op.enrich_countries(personal, nation_codes(spark, sf_dir, "country"))


def enrich_ports(spark, sf_dir) -> DataFrame:
    fact = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.concat(F.lit("S"), "l_suppkey").alias("city_code"),
        F.col("l_linenumber").cast("string").alias("state_code"),
    )
    cities = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") != 3).select(
        F.concat(F.lit("S"), "s_suppkey").alias("code"), F.col("s_name").alias("city")
    )
    return op.enrich_places(fact, cities, nation_codes(spark, sf_dir, "state"))


def composite_join(spark, sf_dir) -> DataFrame:
    """City records with city statistics whose names are written in upper case."""
    part = table(spark, sf_dir, "part")
    cities = part.select(
        "p_partkey", F.concat(F.lit(" "), "p_name").alias("city"), F.lower("p_type").alias("state")
    )
    stats = part.groupBy(F.upper("p_name").alias("city"), F.upper("p_type").alias("state")).agg(
        F.max("p_size").alias("median_age")
    )
    return op.join_places(cities, stats)


def climate_join(spark, sf_dir) -> DataFrame:
    fact = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.month("l_shipdate").alias("month"),
        F.col("l_linenumber").cast("string").alias("city_code"),
    )
    ports = nation_codes(spark, sf_dir, "city").select(
        "code", F.concat("city", F.lit(", XX  ")).alias("city")
    )
    climate = an.climatology(priced_places(spark, sf_dir), years=3)
    return op.climate_by_arrival(fact, ports, climate).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "month", "city_key",
        "usual_temperature",
    )


def recent_climate(spark, sf_dir) -> DataFrame:
    return an.recent_temperatures(priced_places(spark, sf_dir), 2017, years=2)


def warming_vs_origin(spark, sf_dir) -> DataFrame:
    fact, personal = arrivals_by_nation(spark, sf_dir)
    li, supplier, nation = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    temperature = (
        li.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.lower("n_name").alias("country"), F.year("l_shipdate").alias("year"),
            F.col("l_quantity").alias("avg_temperature"),
        )
    )
    found = an.warming_and_origins(temperature, fact, personal, nation_codes(spark, sf_dir, "country"))
    return found.select(
        "country_key", "n_years", F.round("correlation", 6).alias("correlation"),
        F.round("warming_per_year", 6).alias("warming_per_year"),
    )


def state_months(spark, sf_dir) -> DataFrame:
    monthly, _ = an.state_trend(arrivals_by_nation(spark, sf_dir)[0])
    return monthly


def state_trend(spark, sf_dir) -> DataFrame:
    _, trend = an.state_trend(arrivals_by_nation(spark, sf_dir)[0])
    return trend.withColumn("slope", F.round("slope", 6))


def age_distribution(spark, sf_dir) -> DataFrame:
    fact, personal = arrivals_by_nation(spark, sf_dir)
    return an.age_distribution(fact, personal, band=5).withColumn("share_pct", F.round("share_pct", 6))


def age_quartiles(spark, sf_dir) -> DataFrame:
    fact, personal = arrivals_by_nation(spark, sf_dir)
    joined = fact.join(personal, "uid")
    found = an.age_quantiles(joined, F.col("year") - F.col("birth_year"), [0.25, 0.5, 0.75])
    return found.select(*[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(3)])


QUERIES = {
    f.__name__: f
    for f in (
        destinations_topk, destinations_of_orders, bucketed_join, enrich_codes, enrich_ports, composite_join,
        climate_join, recent_climate, warming_vs_origin, state_months, state_trend,
        age_distribution, age_quartiles,
    )
}

_ARRIVALS = """
arrivals as (
  select o_orderkey as uid, cast(year(o_orderdate) as int) as year,
         cast(month(o_orderdate) as int) as month, cast(c_nationkey as varchar) as state_code,
         c_nationkey + 1950 as birth_year, c_nationkey
  from orders join customer on o_custkey = c_custkey),
counted as (select state_code, year * 12 + month - 1 as period, count(*) as n from arrivals group by all),
spans as (select state_code, unnest(generate_series(min(period), max(period))) as period from counted group by state_code),
monthly as (
  select state_code, cast(period // 12 as int) as year, cast(period % 12 + 1 as int) as month, coalesce(n, 0) as n_arrivals
  from spans left join counted using (state_code, period))"""


def _climatology(years: int) -> str:
    return f"""
usual as (
  select city, country, month, sum(avg_temperature) / count(*) as avg_temperature, count(*) as n_days
  from (select *, max(year) over (partition by city, country) as last from priced_places)
  where year > last - {years}
  group by city, country, month)"""


ORACLES = {
    "destinations_topk": """
select cast(c_nationkey as varchar) as state_code, n_name as state, count(*) as n_arrivals
from customer left join nation on c_nationkey = n_nationkey
group by all order by n_arrivals desc, state_code nulls last limit 5""",
    "destinations_of_orders": f"""
with {_ARRIVALS}
select state_code, n_name as state, count(*) as n_arrivals
from arrivals left join nation on c_nationkey = n_nationkey
group by all order by n_arrivals desc, state_code nulls last limit 5""",
    "bucketed_join": f"""
with {_ARRIVALS}
select uid, year, month, state_code, c_nationkey as citizen_country, birth_year from arrivals""",
    "enrich_codes": """
select c_custkey as uid, c_nationkey as citizen_country, (c_nationkey + 5) || '.0' as residence_country,
       a.n_name as citizen_country_name, b.n_name as residence_country_name
from customer left join nation a on c_nationkey = a.n_nationkey
left join nation b on c_nationkey + 5 = b.n_nationkey""",
    "enrich_ports": """
select l_orderkey, l_linenumber, l_partkey, l_extendedprice, 'S' || l_suppkey as city_code,
       cast(l_linenumber as varchar) as state_code, s_name as city, n_name as state
from lineitem left join supplier on l_suppkey = s_suppkey and s_nationkey <> 3
left join nation on l_linenumber = n_nationkey""",
    "composite_join": """
select upper(p.p_name) as city_key, upper(p.p_type) as state_key, p.p_partkey,
       ' ' || p.p_name as city, lower(p.p_type) as state, s.median_age
from part p join (
  select upper(p_name) as n, upper(p_type) as t, max(p_size) as median_age from part group by all) s
on upper(p.p_name) = s.n and upper(p.p_type) = s.t""",
    "climate_join": f"""
with {PRICED_PLACES_SQL}, {_climatology(3)}
select l_orderkey, l_linenumber, l_partkey, l_extendedprice, cast(month(l_shipdate) as int) as month,
       n_name as city_key, avg_temperature as usual_temperature
from lineitem left join nation on l_linenumber = n_nationkey
left join usual on lower(n_name) = city and month(l_shipdate) = usual.month""",
    "recent_climate": f"""
with {PRICED_PLACES_SQL}, {_climatology(2)}
select city, country, month, avg_temperature, n_days,
       cast(2017 as int) as year
from usual""",
    "warming_vs_origin": f"""
with {_ARRIVALS},
warming as (
  select upper(n_name) as country_key, cast(year(l_shipdate) as int) as year, avg(l_quantity) as t
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  group by all),
origins as (
  select upper(n_name) as country_key, year, count(*) as n
  from arrivals join nation on c_nationkey = n_nationkey group by all)
select country_key, count(*) as n_years, round(corr(t, cast(n as double)), 6) as correlation,
       round(regr_slope(t, cast(year as double)), 6) as warming_per_year
from warming join origins using (country_key, year) group by country_key""",
    "state_months": f"""
with {_ARRIVALS}
select *, n_arrivals - lag(n_arrivals) over (partition by state_code order by year, month) as change
from monthly""",
    "state_trend": f"""
with {_ARRIVALS},
slopes as (
  select state_code, regr_slope(cast(n_arrivals as double), cast(year * 12 + month as double)) as s,
         cast(sum(n_arrivals) as bigint) as n_arrivals
  from monthly group by state_code)
select state_code, round(s, 6) as slope, n_arrivals,
       case when s > 0 then 'increasing' when s < 0 then 'decreasing' when s = 0 then 'flat' end
         as direction
from slopes""",
    "age_distribution": f"""
with {_ARRIVALS}
select cast(floor((year - birth_year) / 5) * 5 as int) as age_from, count(*) as n,
       round(count(*) * 100.0::double / sum(count(*)) over (), 6) as share_pct
from arrivals group by 1""",
    "age_quartiles": f"""
with {_ARRIVALS}
select quantile_cont(cast(year - birth_year as double), 0.25) as q1,
       quantile_cont(cast(year - birth_year as double), 0.5) as q2,
       quantile_cont(cast(year - birth_year as double), 0.75) as q3
from arrivals""",
}
