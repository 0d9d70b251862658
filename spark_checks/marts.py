"""Whole table plans, fed from source files that Spark writes out of the given tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmart import analytics as an, operators as op
from starmart.contracts import FACT_IMMIGRATION
from starmart.plans import data_dictionary, run
from starmart.plans.recipes import RECIPES
from starmart.quality import check_table
from starmart.session import new_path
from starmart.sinks import create_table_sql, current_version, files_of, key_ranges, look_up, publish, repeated_keys, stage

from .inputs import (
    ARRIVALS_SQL, DEMOGRAPHICS_SQL, TEMPERATURES_SQL, airports, arrivals, as_csv, demographics,
    nation_codes, table, temperatures,
)


def _build(spark, sf_dir, name: str, source: str, rows: DataFrame, sep: str = ",", **options):
    dst = new_path(spark, "mart")
    built = run(
        spark, "", dst, tables=[name], paths={source: as_csv(rows, source, sep)},
        checks=False, **options,
    )
    return built[name], dst


def mart_fact(spark, sf_dir) -> DataFrame:
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", arrivals(spark, sf_dir))
    return built.read(spark)


def mart_fact_counts(spark, sf_dir) -> DataFrame:
    """What became of the source rows, as the report table of the run holds it."""
    _, dst = _build(spark, sf_dir, "fact_immigration", "immigration", arrivals(spark, sf_dir))
    return spark.read.parquet(f"{dst}/qc_report")


def mart_fact_quarantine(spark, sf_dir) -> DataFrame:
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", arrivals(spark, sf_dir))
    return spark.read.parquet(built.quarantine)


def _wide_arrivals(spark, sf_dir) -> DataFrame:
    """Arrivals whose keys are beyond 32 bits, text, fractions and missing as well as plain."""
    number = F.col("cicid").cast("decimal(20,1)").cast("bigint")
    kind = F.pmod(number, F.lit(7))
    key = (
        F.when(kind == 0, F.concat(F.lit("K"), number.cast("string")))
        .when(kind == 1, F.concat(number.cast("string"), F.lit(".5")))
        .when(kind == 2, (number + 3_000_000_000).cast("string"))
        .when(kind == 3, F.concat((number + 9_000_000_000_000_000).cast("string"), F.lit(".0")))
        .otherwise(F.col("cicid"))
    )
    return arrivals(spark, sf_dir).withColumn("cicid", key)


def mart_fact_wide_keys(spark, sf_dir) -> DataFrame:
    """The fact's keys, row by row, and the keys set apart."""
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", _wide_arrivals(spark, sf_dir))
    kept = built.read(spark).select("immigration_id", F.col("uid").cast("string").alias("key"), "visa")
    apart = spark.read.parquet(built.bad_keys).select(
        F.lit(None).cast("bigint").alias("immigration_id"), F.col("uid").alias("key"), "visa"
    )
    return kept.unionByName(apart)


def mart_fact_wide_counts(spark, sf_dir) -> DataFrame:
    """What became of rows with such keys; every distinct number is written or counted as missing."""
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", _wide_arrivals(spark, sf_dir))
    rows = [(step, n) for step, n in built.counts.items()] + [("balanced", int(built.balanced))]
    return spark.createDataFrame(rows, "step string, n bigint")


def _refreshed(spark, sf_dir, each=None, **options):
    """A fact table after two overlapping batches, the second brought in twice: it changes a mode and moves arrivals to another state."""
    given = arrivals(spark, sf_dir)
    number = F.col("cicid").cast("decimal(20,1)").cast("bigint")
    third = F.coalesce(F.pmod(number, F.lit(3)), F.lit(1))
    moved = F.when(F.pmod(number, F.lit(6)) == 0, F.lit("ZZ")).otherwise(F.col("i94addr"))
    first = as_csv(given.filter(third != 2), "immigration")
    second = as_csv(given.filter(third != 1).withColumn("i94mode", F.lit("7")).withColumn("i94addr", moved), "immigration")
    dst = new_path(spark, "mart")
    for source, mode in ((first, "overwrite"), (second, "refresh"), (second, "refresh")):
        built = run(spark, "", dst, tables=["fact_immigration"], paths={"immigration": source}, checks=False, mode=mode, **options)
        if each:
            each(built["fact_immigration"])
    return built["fact_immigration"]


def _with_ids(fact: DataFrame) -> DataFrame:
    ids = fact.agg(F.count_distinct("immigration_id").alias("n"), F.max("immigration_id").alias("top")).first()
    return fact.drop("immigration_id").withColumns({
        "n_ids": F.lit(ids.n).cast("bigint"), "next_id": F.lit(ids.top + 1).cast("bigint"),
    })


def mart_fact_refresh(spark, sf_dir) -> DataFrame:
    return _with_ids(_refreshed(spark, sf_dir).read(spark))


def mart_fact_versions(spark, sf_dir) -> DataFrame:
    """The same batches into a table kept as versions."""
    return _with_ids(_refreshed(spark, sf_dir, versioned=True).read(spark))


def mart_fact_aligned(spark, sf_dir) -> DataFrame:
    """The same batches into a table in buckets of the arrival number."""
    return _with_ids(_refreshed(spark, sf_dir, aligned=8).read(spark))


def mart_aligned_ages(spark, sf_dir) -> DataFrame:
    """Ages of the arrivals, from two tables in the same buckets."""
    source = as_csv(arrivals(spark, sf_dir), "immigration")
    names = ["fact_immigration", "dim_immigration_personal"]
    built = run(spark, "", new_path(spark, "mart"), tables=names, paths={"immigration": source}, checks=False, aligned=8)
    found = an.age_distribution(*(built[n].read(spark) for n in names), band=5)
    return found.withColumn("share_pct", F.round("share_pct", 6))


def mart_months_refreshed(spark, sf_dir) -> DataFrame:
    """Arrivals by state and month, kept in step with the refreshes by their changes alone."""
    counted: list[DataFrame] = []

    def follow(fact) -> None:
        change = fact.change
        now = an.months_after(counted[-1], change.added, change.replaced) if change else an.arrivals_by_month(fact.read(spark))
        counted.append(stage(now, "months"))

    _refreshed(spark, sf_dir, follow, versioned=True, keep_steps=True)
    return counted[-1]


def _versioned(spark, sf_dir):
    dst = new_path(spark, "mart")
    source = as_csv(arrivals(spark, sf_dir), "immigration")
    return run(spark, "", dst, tables=["fact_immigration"], paths={"immigration": source}, checks=False, versioned=True)["fact_immigration"]


def mart_fact_look_up(spark, sf_dir) -> DataFrame:
    """Look-ups of the arrivals of the first tenth of the keys in a table kept as versions."""
    fact = _versioned(spark, sf_dir)
    top = fact.read(spark).agg(F.max("uid")).first()[0]
    keys = fact.read(spark).select("uid").where(F.col("uid") * 10 < top)
    return look_up(spark, fact.path, fact.contract.schema, "uid", keys)


def mart_fact_repeats(spark, sf_dir) -> DataFrame:
    """Keys that a batch brought in beside stored rows instead of in their place, looked for in the files that meet the batch."""
    fact = _versioned(spark, sf_dir)
    path, number = fact.path, current_version(spark, fact.path)
    batch = fact.read(spark).where("uid % 1000 = 1")
    publish(batch, path, "uid", fact.contract.partition_by, fact.contract.id_column, files_of(spark, path), number)
    return repeated_keys(spark, path, fact.contract.schema, ["uid"], key_ranges(batch, "uid"))


def mart_fact_parquet_sparse(spark, sf_dir) -> DataFrame:
    """The same table from a Parquet source with sparse ids: the ids are unique."""
    path = new_path(spark, "arrivals")
    arrivals(spark, sf_dir).write.parquet(path)
    built = run(
        spark, "", new_path(spark, "mart"), tables=["fact_immigration"], ids="sparse",
        paths={"immigration": path}, formats={"immigration": "parquet"}, checks=False,
    )["fact_immigration"]
    fact = built.read(spark)
    return fact.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("immigration_id").alias("n_ids"),
        F.count_distinct("uid").alias("n_uids"), F.sum("visa").alias("visas"),
    )


def mart_personal(spark, sf_dir) -> DataFrame:
    built, _ = _build(
        spark, sf_dir, "dim_immigration_personal", "immigration", arrivals(spark, sf_dir)
    )
    return built.read(spark)


def mart_airline(spark, sf_dir) -> DataFrame:
    built, _ = _build(
        spark, sf_dir, "dim_immigration_airline", "immigration", arrivals(spark, sf_dir)
    )
    return built.read(spark)


def mart_temperature(spark, sf_dir) -> DataFrame:
    built, _ = _build(spark, sf_dir, "dim_temperature", "temperature", temperatures(spark, sf_dir))
    return built.read(spark)


def mart_temperature_by_date(spark, sf_dir) -> DataFrame:
    """One row per date over all countries, dates that cannot be read rejected."""
    recipes = RECIPES | {
        "dim_temperature": replace(RECIPES["dim_temperature"], key=("date",))
    }
    built, _ = _build(
        spark, sf_dir, "dim_temperature", "temperature", temperatures(spark, sf_dir),
        recipes=recipes, countries=None, reject_bad_dates=True,
    )
    return built.read(spark)


def mart_demography(spark, sf_dir) -> DataFrame:
    built, _ = _build(spark, sf_dir, "dim_demography", "demography", demographics(spark, sf_dir), ";")
    return built.read(spark)


def mart_demography_stats(spark, sf_dir) -> DataFrame:
    built, _ = _build(
        spark, sf_dir, "dim_demography_stats", "demography", demographics(spark, sf_dir), ";"
    )
    return built.read(spark)


def mart_airport(spark, sf_dir) -> DataFrame:
    built, _ = _build(spark, sf_dir, "dim_airport", "airport", airports(spark, sf_dir))
    return built.read(spark)


def mart_declared(spark, sf_dir) -> DataFrame:
    """The written fact table declared in the catalog and queried by SQL."""
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", arrivals(spark, sf_dir))
    name = "declared_fact_immigration"
    spark.sql(f"drop table if exists {name}")
    spark.sql(create_table_sql(FACT_IMMIGRATION, built.path, name))
    spark.sql(f"msck repair table {name}")
    return spark.sql(f"""
        select state_code, year, count(*) as n_arrivals, min(arrive_date) as first_day
        from {name} group by state_code, year""")


def mart_qc_report(spark, sf_dir) -> DataFrame:
    """Every check of the fact table's contract, against code tables that lack some codes."""
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", arrivals(spark, sf_dir))
    supplier = table(spark, sf_dir, "supplier")
    cities = supplier.filter(F.col("s_nationkey") != 3).select(
        F.concat(F.lit("S"), "s_suppkey").alias("code"), F.col("s_name").alias("city")
    )
    states = nation_codes(spark, sf_dir, "state")
    tables = {"city_code": cities, "state_code": states}
    return check_table(built.read(spark), FACT_IMMIGRATION, tables, built.written_schema(spark))


def dictionary_live(spark, sf_dir) -> DataFrame:
    """The fact table's dictionary next to the written table's types and value counts."""
    built, _ = _build(spark, sf_dir, "fact_immigration", "immigration", arrivals(spark, sf_dir))
    fact = built.read(spark)
    described = data_dictionary(
        spark, {"fact_immigration": fact}, {"fact_immigration": FACT_IMMIGRATION}
    )
    held = op.profile(fact).select(
        "column_name", (F.col("n_rows") - F.col("n_missing")).alias("n_values")
    )
    return (
        described.join(held, "column_name")
        .select("table_name", "position", "column_name", "data_type", "found_type", "n_values")
    )


def mart_whole(spark, sf_dir) -> DataFrame:
    """All ten tables in one run, with all checks: the rows each holds."""
    nation = table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey")
    labels = new_path(spark, "source-labels")
    line = F.concat(F.lit("\t'"), F.col("n_nationkey"), F.lit("'\t=\t'"), F.col("n_name"), F.lit("'"))
    nation.select(line.alias("value")).write.text(labels)
    built = run(spark, "", new_path(spark, "mart"), paths={
        "immigration": as_csv(arrivals(spark, sf_dir), "immigration"),
        "temperature": as_csv(temperatures(spark, sf_dir), "temperature"),
        "demography": as_csv(demographics(spark, sf_dir), "demography", ";"),
        "airport": as_csv(airports(spark, sf_dir), "airport"),
        "labels": labels,
    })
    return reduce(DataFrame.unionByName, [
        op.row_count(b.read(spark)).select(F.lit(name).alias("table_name"), "n_rows")
        for name, b in built.items()
    ])


def vertical_split(spark, sf_dir) -> DataFrame:
    """Orders cut into a fact and two dimensions, put together again by key."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    parts = op.split_columns(orders, ["o_orderkey"], {
        "fact": ["o_orderdate", "o_totalprice"], "personal": ["o_custkey"],
        "airline": ["o_orderstatus", "o_orderpriority"],
    })
    joined = op.join_on_uid(parts["fact"], parts["personal"], "o_orderkey")
    return op.join_on_uid(joined, parts["airline"], "o_orderkey", "left")


QUERIES = {
    f.__name__: f
    for f in (
        mart_fact, mart_fact_counts, mart_fact_quarantine, mart_fact_parquet_sparse, mart_fact_wide_keys, mart_fact_wide_counts, mart_fact_refresh,
        mart_fact_versions, mart_fact_aligned, mart_aligned_ages, mart_fact_look_up, mart_fact_repeats, mart_months_refreshed,
        mart_personal,
        mart_airline, mart_temperature, mart_temperature_by_date, mart_demography,
        mart_demography_stats, mart_airport, mart_whole, mart_declared, mart_qc_report, dictionary_live,
        vertical_split,
    )
}

_FACT = f"""
with {ARRIVALS_SQL},
survivors as (
  select uid, year, month, city_code, state_code, arrive_date, departure_date, mode, visa
  from (
    select *, row_number() over (
      partition by uid
      order by (uid is null)::int + (arrive_date is null)::int + (visa is null)::int,
               year nulls last, month nulls last, city_code nulls last, state_code nulls last,
               arrive_date nulls last, departure_date nulls last, mode nulls last,
               visa nulls last) as rn
    from arrivals)
  where rn = 1),
fact as (
  select row_number() over (order by uid) - 1 as immigration_id, *, 'United States' as country
  from survivors
  where uid is not null and arrive_date is not null and visa is not null)"""

_TEMPERATURE = """
  select try_cast(dt as date) as date, avg_temperature, avg_temperature_uncertainty, city, country,
         cast(year(try_cast(dt as date)) as int) as year,
         cast(month(try_cast(dt as date)) as int) as month
  from survivors where dt is not null and city is not null"""

_FACT_COLUMNS = [
    ("immigration_id", "bigint"), ("uid", "bigint"), ("year", "int"), ("month", "int"),
    ("city_code", "string"), ("state_code", "string"), ("arrive_date", "date"),
    ("departure_date", "date"), ("mode", "int"), ("visa", "int"), ("country", "string"),
]

_WIDE = _FACT.replace(
    "arrivals as (", "given as (", 1
).replace(
    "survivors as (", """keyed as (
  select *, case uid % 7 when 0 then 'K' || uid when 1 then uid || '.5' when 2 then (uid + 3000000000)::varchar
    when 3 then (uid + 9000000000000000)::varchar else uid::varchar end as k from given),
bad as (select k, visa from keyed where uid % 7 in (0, 1)),
arrivals as (select * exclude (k) replace (try_cast(k as bigint) as uid) from keyed where uid is null or uid % 7 not in (0, 1)),
survivors as (""", 1
)

_MERGED = _FACT.replace("arrivals as (", "given as (", 1).replace("survivors as (", """arrivals as (
  select * replace (case when uid % 3 <> 1 then 7 else mode end as mode,
                    case when uid % 6 = 0 then 'ZZ' else state_code end as state_code) from given),
survivors as (""", 1)

ORACLES = {
    "mart_fact_refresh": f"""{_MERGED}
select * exclude (immigration_id), count(*) over () as n_ids, count(*) over () as next_id from fact""",
    "mart_fact_versions": f"""{_MERGED}
select * exclude (immigration_id), count(*) over () as n_ids, count(*) over () as next_id from fact""",
    "mart_fact_aligned": f"""{_MERGED}
select * exclude (immigration_id), count(*) over () as n_ids, count(*) over () as next_id from fact""",
    "mart_aligned_ages": f"""{_FACT},
people as (
  select uid, birth_year, row_number() over (
    partition by uid order by citizen_country nulls last, residence_country nulls last, birth_year nulls last,
      gender nulls last, ins_num nulls last) as rn
  from arrivals)
select cast(floor((year - birth_year) / 5) * 5 as int) as age_from, count(*) as n,
       round(count(*) * 100.0::double / sum(count(*)) over (), 6) as share_pct
from fact join people using (uid) where rn = 1 group by 1""",
    "mart_months_refreshed": f"""{_MERGED}
select state_code, year, month, count(*) as n from fact group by all""",
    "mart_fact_look_up": f"""{_FACT}
select * from fact where uid * 10 < (select max(uid) from fact)""",
    "mart_fact_repeats": f"""{_FACT}
select uid, 2::bigint as n from fact where uid % 1000 = 1""",
    "mart_fact_wide_keys": f"""{_WIDE}
select immigration_id, uid::varchar as key, visa from fact union all select null, k, visa from bad""",
    "mart_fact_wide_counts": f"""{_WIDE},
c as (select (select count(*) from given) as n_in, (select count(*) from bad) as n_bad, (select count(*) from survivors) as n_keys,
  (select count(*) from fact) as n_out)
select r.step, r.n::bigint as n from c, lateral (values ('read', n_in), ('filtered', 0), ('bad_keys', n_bad),
  ('missing', n_keys - n_out), ('removed', n_in - n_bad - n_keys), ('bad_dates', 0), ('written', n_out), ('balanced', 1)) as r(step, n)""",
    "mart_fact": f"{_FACT} select * from fact",
    "mart_fact_counts": f"""{_FACT},
counts as (
  select (select count(*) from arrivals) as n_in, (select count(*) from survivors) as n_keys,
         (select count(*) from fact) as n_out,
         (select count(*) from survivors where uid is null) as m1,
         (select count(*) from survivors where uid is not null and arrive_date is null) as m2,
         (select count(*) from survivors
          where uid is not null and arrive_date is not null and visa is null) as m3)
select 'fact_immigration' as table_name, r.check_name, r.column_name, r.value, 'ok' as status
from counts, lateral (values
  ('rows', 'read', n_in), ('rows', 'filtered', 0), ('rows', 'missing', m1 + m2 + m3),
  ('rows', 'removed', n_in - n_keys), ('rows', 'bad_keys', 0), ('rows', 'bad_dates', 0), ('rows', 'written', n_out),
  ('missing', 'uid', m1), ('missing', 'arrive_date', m2), ('missing', 'visa', m3),
  ('row_balance', '', 0)) as r(check_name, column_name, value)""",
    "mart_fact_quarantine": f"""{_FACT}
select * from survivors where uid is null or arrive_date is null or visa is null""",
    "mart_fact_parquet_sparse": f"""{_FACT}
select count(*) as n_rows, count(*) as n_ids, count(*) as n_uids, cast(sum(visa) as bigint) as visas
from fact""",
    "mart_personal": f"""
with {ARRIVALS_SQL},
survivors as (
  select uid, citizen_country, residence_country, birth_year, gender, ins_num
  from (
    select *, row_number() over (
      partition by uid
      order by citizen_country nulls last, residence_country nulls last, birth_year nulls last,
               gender nulls last, ins_num nulls last) as rn
    from arrivals)
  where rn = 1)
select row_number() over (order by uid) - 1 as immi_personal_id, *
from survivors where uid is not null""",
    "mart_airline": f"""
with {ARRIVALS_SQL},
survivors as (
  select uid, airline, admission_num, flight_number, visa_type
  from (
    select *, row_number() over (
      partition by uid
      order by airline nulls last, admission_num nulls last, flight_number nulls last,
               visa_type nulls last) as rn
    from arrivals where uid is not null and admission_num is not null)
  where rn = 1)
select row_number() over (order by uid) - 1 as immi_airline_id, * from survivors""",
    "mart_temperature": f"""
with {TEMPERATURES_SQL},
survivors as (
  select * from (
    select *, row_number() over (
      partition by dt, city, country
      order by avg_temperature nulls last, avg_temperature_uncertainty nulls last) as rn
    from temperatures where country = 'United States')
  where rn = 1)
{_TEMPERATURE}""",
    "mart_temperature_by_date": f"""
with {TEMPERATURES_SQL},
survivors as (
  select * from (
    select *, row_number() over (
      partition by dt
      order by (city is null)::int, avg_temperature nulls last,
               avg_temperature_uncertainty nulls last, city nulls last, country nulls last) as rn
    from temperatures)
  where rn = 1)
{_TEMPERATURE} and try_cast(dt as date) is not null""",
    "mart_demography": f"""
with {DEMOGRAPHICS_SQL}
select row_number() over (
         order by city nulls last, state nulls last, male_population nulls last,
                  female_population nulls last, number_of_veterans nulls last,
                  foreign_born nulls last, race nulls last) - 1 as demog_pop_id, *
from (
  select distinct city, state, male_population, female_population, number_of_veterans,
                  foreign_born, race
  from demographics where city is not null and state is not null)""",
    "mart_demography_stats": f"""
with {DEMOGRAPHICS_SQL}
select row_number() over (order by city, state, median_age, average_household_size) - 1
         as demog_stat_id,
       upper(city) as city, upper(state) as state, median_age, average_household_size
from (
  select distinct city, state, median_age, average_household_size
  from demographics where city is not null and state is not null)""",
    "mart_airport": """
with airports as (
  select case when c_mktsegment <> 'FURNITURE' then 'K' || (c_custkey // 3) end as ident,
         lower(c_mktsegment) as type, c_name as airport_name,
         cast(trunc(c_acctbal) as int) as elevation_ft, 'US' as iso_country,
         'US-' || c_nationkey as iso_region, c_name as municipality,
         cast(c_custkey as varchar) as gps_code, cast(c_custkey as varchar) as local_code,
         case when c_nationkey <> 3 then c_custkey || '.5, -' || c_nationkey end as coordinates
  from customer)
select * exclude (rn) from (
  select *, row_number() over (
    partition by ident
    order by (ident is null)::int + (coordinates is null)::int, type, airport_name) as rn
  from airports)
where rn = 1 and ident is not null and coordinates is not null""",
    "mart_whole": f"""
with {ARRIVALS_SQL}, {TEMPERATURES_SQL}, {DEMOGRAPHICS_SQL}
select 'fact_immigration' as table_name, count(distinct uid) as n_rows from arrivals
where arrive_date is not null and visa is not null
union all
select 'dim_immigration_personal', count(distinct uid) from arrivals
union all
select 'dim_immigration_airline', count(distinct uid) from arrivals where admission_num is not null
union all
select 'country_code', count(*) from nation where n_nationkey >= 10
union all
select 'city_code', 0
union all
select 'state_code', 0
union all
select 'dim_temperature', count(distinct (dt, city)) from temperatures
where country = 'United States' and city is not null
union all
select 'dim_demography', count(distinct (city, state, male_population, female_population,
                                         number_of_veterans, foreign_born, race))
from demographics where city is not null
union all
select 'dim_demography_stats', count(distinct (city, state, median_age, average_household_size))
from demographics where city is not null
union all
select 'dim_airport', count(distinct c_custkey // 3) from customer
where c_mktsegment <> 'FURNITURE' and c_nationkey <> 3""",
    "mart_declared": f"""{_FACT}
select state_code, year, count(*) as n_arrivals, min(arrive_date) as first_day
from fact group by state_code, year""",
    "mart_qc_report": f"""{_FACT},
found as (
  {" union all ".join(
      f"select 'data_type' as check_name, '{name}' as column_name, 0 as value"
      for name, _ in _FACT_COLUMNS)}
  union all
  select 'primary_key_unique', 'uid', 0
  union all
  select 'primary_key_not_null', 'uid', (select count(*) from fact where uid is null)
  union all
  select 'not_null', 'uid', 0
  union all
  select 'not_null', 'arrive_date', 0
  union all
  select 'not_null', 'visa', 0
  union all
  select 'foreign_key', 'state_code->state_code',
         (select count(*) from fact where state_code is not null
          and state_code not in (select cast(n_nationkey as varchar) from nation))
  union all
  select 'foreign_key', 'city_code->city_code',
         (select count(*) from fact where city_code not in (
            select 'S' || s_suppkey from supplier where s_nationkey <> 3)))
select 'fact_immigration' as table_name, check_name, column_name, value,
       case when value = 0 then 'ok' else 'failed' end as status
from found""",
    "dictionary_live": f"""{_FACT}
{" union all ".join(
    f"select 'fact_immigration' as table_name, {i} as position, '{name}' as column_name, "
    f"'{dtype}' as data_type, '{dtype}' as found_type, count({name}) as n_values from fact"
    for i, (name, dtype) in enumerate(_FACT_COLUMNS))}""",
    "vertical_split": """
select o_orderkey, cast(o_orderdate as date) as o_orderdate, o_totalprice, o_custkey, o_orderstatus,
       o_orderpriority
from orders""",
}
