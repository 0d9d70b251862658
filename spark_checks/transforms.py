"""Sources, projections, filters, distinct, keys and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from starmart import functions as fn, operators as op
from starmart.session import new_path
from starmart.sinks import refresh_partitions, write_csv, write_table
from starmart.sources import (
    LabelSection, label_rejects, parse_labels, read_csv, read_lines, read_table,
)

from .inputs import sas_days, table


def select_rename(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    picked = op.project(orders, ["o_orderkey", "o_custkey", "o_orderstatus"])
    renamed = op.rename(picked, {"o_orderkey": "uid", "o_orderstatus": "state_code", "absent": "x"})
    named = op.rename_positional(renamed, ["uid", "person", "state_code"])
    return op.add_constant(named, "country", "United States")


def normalised_names(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Key"), F.col("p_size").alias("Foreign-born"),
        F.col("p_retailprice").alias("Average Household Size"),
    )
    return op.normalise_names(part)


def distinct_projection(spark, sf_dir) -> DataFrame:
    return op.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


def dedupe_on_key(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return op.dedupe(li, ["l_orderkey", "l_linenumber"])


def dedupe_ordered(spark, sf_dir) -> DataFrame:
    """The latest shipment per order, complete rows first."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    return op.dedupe(
        li, "l_orderkey", order_by=[F.col("l_shipdate").desc_nulls_last()],
        prefer_complete=["l_returnflag"],
    )


def dedupe_report(spark, sf_dir) -> DataFrame:
    return op.dedupe_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _gappy_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )


def drop_missing(spark, sf_dir) -> DataFrame:
    return op.drop_missing(_gappy_orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])


def missing_report_sequential(spark, sf_dir) -> DataFrame:
    return op.missing_report(
        _gappy_orders(spark, sf_dir), ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    )


def equality_filter(spark, sf_dir) -> DataFrame:
    return op.equal_to(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


def membership_filter(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY"))
    )
    return op.equal_to(customer, "c_mktsegment", "BUILDING", "MACHINERY", "HOUSEHOLD")


def range_filter(spark, sf_dir) -> DataFrame:
    return op.in_range(table(spark, sf_dir, "part"), "p_size", 10, 20)


def sas_date_roundtrip(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("days", sas_days(F.col("o_orderdate")))
    return orders.select(
        "o_orderkey",
        fn.sas_to_date("days", orders.schema["days"].dataType).alias("order_date"),
        fn.sas_to_date(F.col("days") + F.lit(0.75), DoubleType()).alias("truncated"),
        fn.sas_to_date(F.col("days") + F.lit(3_000_000), LongType()).alias("too_late"),
    )


def sas_date_text_policy(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "days", F.concat(sas_days(F.col("o_orderdate")).cast("string"),
                         F.when(F.col("o_orderstatus") == "F", ".0")
                         .when(F.col("o_orderstatus") == "O", "").otherwise("x"))
    )
    return orders.select(
        "o_orderkey",
        fn.sas_to_date("days", policy="strict").alias("strict"),
        fn.sas_to_date("days", policy="lenient").alias("lenient"),
    )


def sas_timestamp_fraction(spark, sf_dir) -> DataFrame:
    days = sas_days(F.col("ts")) + F.floor(F.hour("ts") / 6) * 0.25
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(fn.sas_to_timestamp(days), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("moment"),
    )


def calendar_columns(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    parsed = op.replace_columns(orders, {"day": fn.to_date("day")})
    return op.add_calendar(parsed, "day")


def date_parse_failures(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-13-dd"))
        .otherwise("soon").alias("day"),
    )
    return orders.select("o_orderkey", fn.to_date("day").alias("day"))


def upper_normalise(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return part.select(
        "p_partkey", F.upper("p_name").alias("upper_name"), fn.upper_trim(padded).alias("join_name")
    )


def _written_lines(df: DataFrame, line, order: str) -> DataFrame:
    """Label text files with the lines in the given order, read back with their numbers."""
    path = new_path(df.sparkSession, "source-labels")
    df.sort(order).select(line.alias("value")).write.text(path)
    return read_lines(df.sparkSession, path)


def label_parse(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    line = F.concat(F.lit("\t'"), F.col("c_custkey"), F.lit("'\t=\t'"), F.col("c_name"), F.lit("  '  "))
    section = LabelSection(
        "city_code", "label", 0, None,
        lambda c: fn.strip_quotes(fn.strip_blank(fn.strip_tabs(c))),
        lambda c: fn.strip_quotes(fn.strip_blank(fn.strip_tabs(c))),
    )
    return parse_labels(_written_lines(customer, line, "c_custkey"), section)


def label_strip_rules(spark, sf_dir) -> DataFrame:
    """The three strip chains on the same texts: blanks before a code stay in the last one."""
    code = F.concat(F.lit("\t '"), F.col("n_nationkey").cast("string"), F.lit("'\t"))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        fn.strip_blank(code).alias("as_country"),
        fn.strip_quotes(fn.strip_blank(fn.strip_tabs(code))).alias("as_city"),
        fn.strip_quotes(fn.strip_tabs(code)).alias("as_state"),
    )


def label_last_wins(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    line = F.concat(F.col("c_nationkey").cast("string"), F.lit(" = '"), F.col("c_name"), F.lit("=cut'"))
    section = LabelSection(
        "country_code", "label", 0, None, fn.strip_blank,
        lambda c: fn.strip_quotes(fn.strip_blank(c)),
    )
    return parse_labels(_written_lines(customer, line, "c_custkey"), section)


def label_section(spark, sf_dir) -> DataFrame:
    """Lines 5 to 19 of one file that holds the whole nation table."""
    nation = table(spark, sf_dir, "nation").coalesce(1)
    line = F.concat(F.lit("  "), F.col("n_nationkey"), F.lit(" =  '"), F.col("n_name"), F.lit("'"))
    path = new_path(spark, "source-labels")
    nation.sortWithinPartitions("n_nationkey").select(line.alias("value")).write.text(path)
    section = LabelSection(
        "country_code", "country", 5, 20, fn.strip_blank,
        lambda c: fn.strip_quotes(fn.strip_blank(c)),
    )
    return parse_labels(read_lines(spark, path), section)


def label_line_rejects(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    sign = F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(" = ")
    line = F.concat(F.col("c_custkey").cast("string"), sign, F.col("c_name"))
    section = LabelSection("country_code", "label", 0, None, fn.strip_blank, fn.strip_blank)
    return label_rejects(_written_lines(customer, line, "c_custkey"), section).select("line")


def drop_sparse_columns(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("iata_code"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_custkey")).alias("ins_num"),
    )
    return op.drop_sparse(orders, 45.0, keep=["ins_num"])


def dense_id(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return op.dense_id(customer, "person_id", ["c_mktsegment", "c_nationkey"])


def dense_id_text_key(spark, sf_dir) -> DataFrame:
    li = op.distinct_rows(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"]
    )
    return op.dense_id(li, "line_id", ["l_returnflag", "l_linestatus"])


def sparse_id(spark, sf_dir) -> DataFrame:
    numbered = op.sparse_id(table(spark, sf_dir, "lineitem").select("l_orderkey"), "id")
    return numbered.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        (F.min("id") >= 0).alias("not_negative"),
    )


def partitioned_roundtrip(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
    )
    path = new_path(spark, "orders")
    write_table(orders, path, ["o_orderstatus"])
    return read_table(spark, path, schema=orders.schema)


def partition_refresh(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = new_path(spark, "orders")
    write_table(orders, path, ["o_orderstatus"])
    changed = op.equal_to(orders, "o_orderstatus", "F").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    for _ in range(2):  # a repeated refresh changes nothing
        refresh_partitions(changed, path, ["o_orderstatus"])
    return read_table(spark, path, ["o_orderkey", "o_totalprice", "o_orderstatus"], orders.schema)


def csv_roundtrip(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = new_path(spark, "customer")
    write_csv(customer, path)
    return read_csv(spark, path, schema=customer.schema)


def csv_semicolon(spark, sf_dir) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").withColumn("note", F.lit("a,b; c"))
    path = new_path(spark, "supplier")
    write_csv(supplier, path, sep=";")
    return op.replace_columns(
        read_csv(spark, path, sep=";"),
        {"s_suppkey": F.col("s_suppkey").cast("bigint"), "s_nationkey": F.col("s_nationkey").cast("int"),
         "s_acctbal": F.col("s_acctbal").cast("double")},
    )


def csv_malformed(spark, sf_dir) -> DataFrame:
    """Cells that are no number become NULL, their rows are kept and marked; ``NA`` is missing."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice").cast("string"))
        .otherwise("n/a").alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("NA")
        .alias("priority"),
    )
    path = new_path(spark, "orders")
    write_csv(orders, path)
    schema = StructType([
        StructField("o_orderkey", LongType()), StructField("price", DoubleType()),
        StructField("priority", StringType()),
    ])
    back = read_csv(spark, path, schema=schema, null_values=["NA"], corrupt_column="_corrupt_record")
    return back.select(
        "o_orderkey", "price", "priority", F.col("_corrupt_record").isNotNull().alias("corrupt")
    )


QUERIES = {
    f.__name__: f
    for f in (
        select_rename, normalised_names, distinct_projection, dedupe_on_key, dedupe_ordered,
        dedupe_report, drop_missing, missing_report_sequential, equality_filter, membership_filter,
        range_filter, sas_date_roundtrip, sas_date_text_policy, sas_timestamp_fraction,
        calendar_columns, date_parse_failures, upper_normalise, label_parse, label_strip_rules,
        label_last_wins, label_section, label_line_rejects, drop_sparse_columns, dense_id,
        dense_id_text_key, sparse_id, partitioned_roundtrip, partition_refresh, csv_roundtrip,
        csv_semicolon, csv_malformed,
    )
}

ORACLES = {
    "select_rename": """
select o_orderkey as uid, o_custkey as person, o_orderstatus as state_code,
       'United States' as country
from orders""",
    "normalised_names": """
select p_partkey as part_key, p_size as foreign_born, p_retailprice as average_household_size
from part""",
    "distinct_projection": "select distinct l_returnflag, l_linestatus from lineitem",
    "dedupe_on_key": """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
from (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber
    order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate) as rn
  from lineitem)
where rn = 1""",
    "dedupe_ordered": """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, flag as l_returnflag, day as l_shipdate
from (
  select *, row_number() over (
    partition by l_orderkey
    order by (flag is null)::int, day desc nulls last, l_linenumber nulls last,
             l_partkey nulls last, l_suppkey nulls last, flag nulls last, day nulls last) as rn
  from (select *, nullif(l_returnflag, 'R') as flag, cast(l_shipdate as date) as day from lineitem))
where rn = 1""",
    "dedupe_report": """
select count(*) as rows_before,
       cast(count(*) - count(distinct (l_orderkey, l_linenumber)) as bigint) as rows_removed,
       count(distinct (l_orderkey, l_linenumber)) as rows_after
from lineitem""",
    "drop_missing": """
select o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority
from orders where nullif(o_orderstatus, 'F') is not null and nullif(o_orderpriority, '5-LOW') is not null""",
    "missing_report_sequential": """
select 0 as position, 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as n_missing
from orders
union all
select 1, 'o_orderstatus', count(*) filter (where o_orderstatus = 'F') from orders
union all
select 2, 'o_orderpriority',
       count(*) filter (where o_orderstatus <> 'F' and o_orderpriority = '5-LOW')
from orders""",
    "equality_filter": "select * from customer where c_mktsegment = 'BUILDING'",
    "membership_filter": """
select * from customer where c_mktsegment in ('BUILDING', 'HOUSEHOLD')""",
    "range_filter": "select * from part where p_size >= 10 and p_size < 20",
    "sas_date_roundtrip": """
select o_orderkey, cast(o_orderdate as date) as order_date, cast(o_orderdate as date) as truncated,
       cast(null as date) as too_late
from orders""",
    "sas_date_text_policy": """
select o_orderkey,
       case when o_orderstatus = 'O' then cast(o_orderdate as date) end as strict,
       case when o_orderstatus in ('O', 'F') then cast(o_orderdate as date) end as lenient
from orders""",
    "sas_timestamp_fraction": """
select event_id,
       strftime(date_trunc('day', ts) + to_hours(cast(6 * (hour(ts) // 6) as int)),
                '%Y-%m-%d %H:%M:%S.%f') as moment
from events""",
    "calendar_columns": """
select o_orderkey, cast(o_orderdate as date) as day, cast(year(o_orderdate) as int) as year,
       cast(month(o_orderdate) as int) as month
from orders""",
    "date_parse_failures": """
select o_orderkey, case when o_orderstatus = 'F' then cast(o_orderdate as date) end as day
from orders""",
    "upper_normalise": """
select p_partkey, upper(p_name) as upper_name, upper(p_name) as join_name from part""",
    "label_parse": """
select cast(c_custkey as varchar) as code, c_name || '  ' as label from customer""",
    "label_strip_rules": """
select n_nationkey, '''' || n_nationkey || '''' as as_country, cast(n_nationkey as varchar) as as_city,
       ' ''' || n_nationkey as as_state
from nation""",
    "label_last_wins": """
select cast(c_nationkey as varchar) as code, arg_max(c_name, c_custkey) as label
from customer group by c_nationkey""",
    "label_section": """
select cast(n_nationkey as varchar) as code, n_name as country
from nation where n_nationkey >= 5 and n_nationkey < 20""",
    "label_line_rejects": """
select c_custkey || ' ' || c_name as line from customer where c_mktsegment = 'BUILDING'""",
    "drop_sparse_columns": """
select o_orderkey, nullif(o_orderstatus, 'F') as o_orderstatus,
       case when o_orderpriority = '2-HIGH' then o_custkey end as ins_num
from orders""",
    "dense_id": """
select c_custkey, c_mktsegment, c_nationkey,
       row_number() over (order by c_mktsegment, c_nationkey, c_custkey) - 1 as person_id
from customer""",
    "dense_id_text_key": """
select l_returnflag, l_linestatus, l_suppkey, l_partkey,
       row_number() over (order by l_returnflag, l_linestatus, l_suppkey, l_partkey) - 1 as line_id
from (select distinct l_returnflag, l_linestatus, l_suppkey, l_partkey from lineitem)""",
    "sparse_id": """
select count(*) as n_rows, count(*) as n_ids, true as not_negative from lineitem""",
    "partitioned_roundtrip": """
select o_orderkey, o_custkey, o_totalprice, nullif(o_orderstatus, 'F') as o_orderstatus
from orders""",
    "partition_refresh": """
select o_orderkey, case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end as o_totalprice,
       o_orderstatus
from orders""",
    "csv_roundtrip": "select * from customer",
    "csv_semicolon": "select *, 'a,b; c' as note from supplier",
    "csv_malformed": """
select o_orderkey, case when o_orderstatus <> 'F' then o_totalprice end as price,
       nullif(o_orderpriority, '5-LOW') as priority, o_orderstatus = 'F' as corrupt
from orders""",
}
