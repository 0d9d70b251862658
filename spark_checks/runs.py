"""Runs of the mart as a whole: default file names, lines and rows set apart, a stop at a failed check, the dictionary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmart.contracts import CONTRACTS
from starmart.plans import QualityError, data_dictionary, run
from starmart.plans.recipes import FACT
from starmart.session import new_path
from starmart.sinks import write_csv
from starmart.sources import LABEL_SECTIONS, SOURCE_FILES

from . import marts
from .inputs import ARRIVALS_SQL, airports, arrivals, as_csv, demographics, table, temperatures

_LABEL_LINES = 1_036


def label_lines(spark, sf_dir) -> DataFrame:
    """(pos, line) of a label file as long as its sections: codes that repeat, lines without a pair, other lines between."""
    numbers = spark.range(_LABEL_LINES).withColumnRenamed("id", "pos")
    # the few orders that make a line are found before orders are grouped: as many rows as lines are shuffled and joined
    orders = table(spark, sf_dir, "orders").withColumn("pos", F.col("o_orderkey").cast("long")).join(numbers, "pos", "left_semi")
    orders = orders.groupBy("pos").agg(F.max("o_custkey").alias("c"))
    code, pos = (F.col(c).cast("string") for c in ("c", "pos"))
    code = F.pmod(F.col("c"), F.lit(400)).cast("string")
    formats = {
        "country_code": F.concat(F.lit("   "), code, F.lit(" =  'country "), pos, F.lit("'")),
        "city_code": F.concat(F.lit("\t'C"), code, F.lit("'\t=\t'town "), pos, F.lit(", XX  '")),
        "state_code": F.concat(F.lit("\t'S"), code, F.lit("'='state "), pos, F.lit("'")),
    }
    line = F.lit("no pair")
    for name, section in LABEL_SECTIONS.items():
        inside = (F.col("pos") >= section.start) & (F.col("pos") < section.stop) & (F.col("pos") % 10 != 7)
        line = F.when(inside & F.col("c").isNotNull(), formats[name]).otherwise(line)
    return numbers.join(orders, "pos", "left").select("pos", line.alias("value"))


def _default_layout(spark, sf_dir) -> str:
    """All sources under their default names below one base path."""
    base = new_path(spark, "base")
    write_csv(arrivals(spark, sf_dir), f"{base}/{SOURCE_FILES['immigration']}", compressed=True)
    write_csv(temperatures(spark, sf_dir), f"{base}/{SOURCE_FILES['temperature']}", compressed=True)
    write_csv(demographics(spark, sf_dir), f"{base}/{SOURCE_FILES['demography']}", ";", compressed=True)
    write_csv(airports(spark, sf_dir), f"{base}/{SOURCE_FILES['airport']}", compressed=True)
    # one file, since lines are counted by file; its length is fixed, and only its lines meet in one task
    lines = label_lines(spark, sf_dir).repartition(1).sortWithinPartitions("pos").select("value")
    lines.write.text(f"{base}/{SOURCE_FILES['labels']}")
    return base


_AS_TEXT = {
    name: [f.name for f in c.schema.fields if f.dataType.simpleString() != "double"] for name, c in CONTRACTS.items()
}


def mart_default_layout(spark, sf_dir) -> DataFrame:
    """Every row of all ten tables, built from files under their default names; measurements are left out of the text."""
    built = run(spark, _default_layout(spark, sf_dir), new_path(spark, "mart"))
    return reduce(DataFrame.unionByName, [
        b.read(spark).select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in _AS_TEXT[name]]).alias("content"),
        ) for name, b in built.items()
    ])


def dictionary_whole(spark, sf_dir) -> DataFrame:
    """The dictionary of all ten tables with descriptions and examples, next to the types found in the written files."""
    built = run(spark, _default_layout(spark, sf_dir), new_path(spark, "mart"), checks=False)
    return data_dictionary(spark, {name: b.read(spark).select(*b.contract.columns) for name, b in built.items()}).join(
        spark.createDataFrame(
            [(name, f.name, f.dataType.simpleString()) for name, b in built.items() for f in b.written_schema(spark)],
            "table_name string, column_name string, file_type string",
        ), ["table_name", "column_name"], "left",
    )


def mart_labels_rejected(spark, sf_dir) -> DataFrame:
    """What became of the lines of each section of the label file."""
    base = new_path(spark, "base")
    lines = label_lines(spark, sf_dir).repartition(1).sortWithinPartitions("pos").select("value")
    lines.write.text(f"{base}/{SOURCE_FILES['labels']}")
    built = run(spark, base, new_path(spark, "mart"), tables=list(LABEL_SECTIONS), checks=False)
    rows = [(name, step, n) for name, b in built.items() for step, n in b.counts.items()]
    return spark.createDataFrame(rows, "table_name string, step string, n bigint")


def mart_lines_apart(spark, sf_dir) -> DataFrame:
    """Arrivals in a file with lines that are too short, too long or hold a quote that is never closed: those lines, and the counts."""
    rows = arrivals(spark, sf_dir).select(*FACT.columns)
    text = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in FACT.columns])
    kind = F.pmod(F.col("depdate").cast("decimal(10,0)"), F.lit(50))
    line = (
        F.when(kind == 0, F.regexp_replace(text, ",[^,]*$", "")).when(kind == 1, F.concat(text, F.lit(",x")))
        .when(kind == 2, F.concat(F.lit('"'), text)).otherwise(text)
    )
    path, dst = new_path(spark, "source-lines"), new_path(spark, "mart")
    # lines as they are, under the header as the name of their one column
    raw = rows.select(line.alias(",".join(FACT.columns))).write.option("header", True).option("sep", "\x01")
    raw.option("quote", "\x00").option("ignoreLeadingWhiteSpace", False).csv(path)
    built = run(
        spark, "", dst, tables=["fact_immigration"], paths={"immigration": path}, checks=False, lines_apart=True
    )["fact_immigration"]
    steps = [(step, n) for step, n in built.counts.items()] + [("balanced", int(built.balanced))]
    counts = spark.createDataFrame(steps, "content string, n bigint")
    lines = spark.read.parquet(f"{dst}/quarantine/immigration_lines").filter(F.col("file").contains(path) & F.col("block").isNotNull())
    return counts.unionByName(lines.groupBy(F.col("line").alias("content")).agg(F.count(F.lit(1)).alias("n")))


def mart_keyless_apart(spark, sf_dir) -> DataFrame:
    """Arrivals without a key counted and kept one by one: the quarantine, and the counts under a text of their own."""
    dst = new_path(spark, "mart")
    built = run(
        spark, "", dst, tables=["fact_immigration"], paths={"immigration": as_csv(arrivals(spark, sf_dir), "immigration")},
        checks=False, keyless_apart=True,
    )["fact_immigration"]
    steps = [*built.counts.items(), *((f"without {c}", n) for c, n in built.missing.items()), ("balanced", int(built.balanced))]
    counts = spark.createDataFrame(steps, "content string, n bigint")
    names = list(FACT.columns.values())
    content = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in names])
    rows = spark.read.parquet(built.quarantine).groupBy(content.alias("content")).agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(rows)


def mart_abort(spark, sf_dir) -> DataFrame:
    """A run told to stop at foreign keys without a parent: the failed checks of its report, and whether the error names each."""
    dst = new_path(spark, "mart")
    said = ""
    try:
        run(
            spark, "", dst, tables=["fact_immigration", "dim_immigration_personal", "dim_immigration_airline"],
            paths={"immigration": as_csv(arrivals(spark, sf_dir), "immigration")}, fail_on=("foreign_key",),
        )
    except QualityError as error:
        said = str(error)
    report = spark.read.parquet(f"{dst}/qc_report").filter(F.col("status") == "failed")
    shown = F.concat(F.col("table_name").cast("string"), F.lit(": "), "check_name", F.lit(" "), "column_name")
    return report.select(
        F.col("table_name").cast("string").alias("table_name"), "check_name", "column_name", "value",
        F.contains(F.lit(said), shown).alias("named"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        mart_default_layout, dictionary_whole, mart_labels_rejected, mart_lines_apart, mart_keyless_apart, mart_abort,
    )
}

_LABELS = """
label_lines as (
  select pos, c, c % 400 as code from (select unnest(range(0, 1036)) as pos)
  join (select o_orderkey as pos, max(o_custkey) as c from orders group by 1) using (pos) where pos % 10 <> 7),
labels as (
  select 'country_code' as table_name, code::varchar as code, max_by('country ' || pos, pos) as label
  from label_lines where pos >= 10 and pos < 298 group by code
  union all
  select 'city_code', 'C' || code, max_by('town ' || pos || ', XX  ', pos) from label_lines where pos >= 303 and pos < 962 group by code
  union all
  select 'state_code', 'S' || code, max_by('state ' || pos, pos) from label_lines where pos >= 982 and pos < 1036 group by code)"""

_TABLE_QUERIES = {
    "fact_immigration": "mart_fact", "dim_immigration_personal": "mart_personal", "dim_immigration_airline": "mart_airline",
    "dim_temperature": "mart_temperature", "dim_demography": "mart_demography", "dim_demography_stats": "mart_demography_stats",
    "dim_airport": "mart_airport",
}


def _content(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, '-')" for c in columns) + ")"


def _literal(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


_LINES = f"""
with {ARRIVALS_SQL.replace('arrivals as (', 'given as (', 1)},
lines as (
  select *, (departure_date - date '1960-01-01') % 50 as kind, concat_ws(',',
    coalesce(uid || '.0', ''), year || '.0', month || '.0', city_code, coalesce(state_code, ''),
    coalesce((arrive_date - date '1960-01-01') || '.0', ''), (departure_date - date '1960-01-01') || '.0',
    mode::varchar, coalesce(visa || '.0', '')) as line
  from given),
apart as (
  select case kind when 0 then regexp_replace(line, ',[^,]*$', '') when 1 then line || ',x' else '"' || line end as line
  from lines where kind in (0, 1, 2)),
arrivals as (select * from lines where kind not in (0, 1, 2)),
keys as (select uid, bool_or(arrive_date is not null and visa is not null) as whole from arrivals group by uid)
select line as content, count(*) as n from apart group by line
union all
select r.step, r.n::bigint from (
  select (select count(*) from given) as n_in, (select count(*) from apart) as n_apart, (select count(*) from keys) as n_keys,
    (select count(*) from keys where whole and uid is not null) as n_out) as c,
  lateral (values ('read', n_in), ('malformed', n_apart), ('bad_keys', 0), ('filtered', 0), ('missing', n_keys - n_out),
    ('removed', n_in - n_apart - n_keys), ('bad_dates', 0), ('written', n_out), ('balanced', 1)) as r(step, n)"""

_KEYLESS = f"""
with {ARRIVALS_SQL},
survivors as (
  select uid, year, month, city_code, state_code, arrive_date, departure_date, mode, visa from (
    select *, row_number() over (
      partition by uid
      order by (arrive_date is null)::int + (visa is null)::int, year nulls last, month nulls last, city_code nulls last,
               state_code nulls last, arrive_date nulls last, departure_date nulls last, mode nulls last, visa nulls last) as rn
    from arrivals where uid is not null)
  where rn = 1),
gone as (
  select * from survivors where arrive_date is null or visa is null
  union all
  select uid, year, month, city_code, state_code, arrive_date, departure_date, mode, visa from arrivals where uid is null)
select {_content(list(FACT.columns.values()))} as content, count(*) as n from gone group by 1
union all
select r.step, r.n::bigint from (
  select (select count(*) from arrivals) as n_in, (select count(*) from survivors) as n_keys, (select count(*) from gone) as n_gone,
    (select count(*) from gone where uid is null) as m1, (select count(*) from gone where uid is not null and arrive_date is null) as m2,
    (select count(*) from gone where uid is not null and arrive_date is not null) as m3) as c,
  lateral (values ('read', n_in), ('bad_keys', 0), ('filtered', 0), ('missing', n_gone), ('removed', n_in - n_keys - m1), ('bad_dates', 0),
    ('written', n_in - n_gone - (n_in - n_keys - m1)), ('without uid', m1), ('without arrive_date', m2), ('without visa', m3),
    ('balanced', 1)) as r(step, n)"""

ORACLES = {
    "mart_default_layout": f"with {_LABELS} select table_name, code || '|' || label as content from labels" + "".join(
        f"\nunion all select '{name}', {_content(_AS_TEXT[name])} from ({marts.ORACLES[query]})"
        for name, query in _TABLE_QUERIES.items()
    ),
    "dictionary_whole": "\nunion all ".join(
        f"select '{c.name}' as table_name, {i} as position, '{f.name}' as column_name, {_literal(f.metadata.get('comment'))} as description, "
        f"'{f.dataType.simpleString()}' as data_type, {_literal(c.examples.get(f.name))} as example, "
        f"'{f.dataType.simpleString()}' as found_type, '{f.dataType.simpleString()}' as file_type"
        for c in CONTRACTS.values() for i, f in enumerate(c.schema.fields)
    ),
    "mart_labels_rejected": f"""
with {_LABELS},
sections as (select unnest([('country_code', 10, 298), ('city_code', 303, 962), ('state_code', 982, 1036)]) as s),
c as (
  select s[1] as table_name, (s[3] - s[2])::bigint as n_in,
    (select count(*) from label_lines where pos >= s[2] and pos < s[3]) as n_pairs,
    (select count(*) from labels where labels.table_name = s[1]) as n_out
  from sections)
select table_name, r.step, r.n::bigint as n from c, lateral (values ('read', n_in), ('filtered', n_in - n_pairs), ('missing', 0),
  ('bad_dates', 0), ('removed', n_pairs - n_out), ('written', n_out)) as r(step, n)""",
    "mart_lines_apart": _LINES,
    "mart_keyless_apart": _KEYLESS,
    "mart_abort": f"""
with {ARRIVALS_SQL},
fact as (select distinct uid from arrivals where uid is not null and arrive_date is not null and visa is not null),
orphans as (
  select 'dim_immigration_personal' as table_name, uid from arrivals where uid is not null
  union
  select 'dim_immigration_airline', uid from arrivals where uid is not null and admission_num is not null)
select table_name, 'foreign_key' as check_name, 'uid->fact_immigration' as column_name, count(*) as value, true as named
from orphans where uid not in (select uid from fact) group by table_name""",
}
