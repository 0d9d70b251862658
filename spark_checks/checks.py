"""Profiles and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from starmart import operators as op, quality as qc
from starmart.contracts import ForeignKey
from starmart.sinks import stage

from .inputs import table


def _gappy_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "1-URGENT", float("nan"))
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )


def null_profile_pct(spark, sf_dir) -> DataFrame:
    return op.profile(_gappy_orders(spark, sf_dir)).select(
        "column_name", "n_missing", F.round("pct_missing", 6).alias("pct_missing")
    )


def duplicate_row_count(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.nullif("l_returnflag", F.lit("A")).alias("l_returnflag"), "l_quantity"
    )
    return op.duplicate_rows(li)


def year_range(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return op.value_range(orders, "year")


def row_counts(spark, sf_dir) -> DataFrame:
    names = ("orders", "lineitem", "events", "customer", "documents", "pages")
    return reduce(DataFrame.unionByName, [
        op.row_count(table(spark, sf_dir, n)).select(F.lit(n).alias("table_name"), "n_rows")
        for n in names
    ])


def profile_columns(spark, sf_dir) -> DataFrame:
    found = op.profile(table(spark, sf_dir, "customer"), exact_distinct=True)
    return found.withColumn("pct_missing", F.round("pct_missing", 6))


def distinct_sketch_bound(spark, sf_dir) -> DataFrame:
    """Exact distinct counts, and whether the union of sketches by status is within 5 % of each."""
    orders = table(spark, sf_dir, "orders")
    keys = ["o_orderkey", "o_custkey", "o_orderdate"]
    parts = op.distinct_sketches(orders, keys, ["o_orderstatus"])
    found = op.estimated_distinct(parts, keys).select(F.posexplode(F.array(*keys)).alias("i", "estimate"))
    exact = orders.agg(*(F.count_distinct(k).alias(k) for k in keys)).select(F.posexplode(F.array(*keys)).alias("i", "n_distinct"))
    close = F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    names = F.get(F.array(*map(F.lit, keys)), F.col("i"))
    return exact.join(found, "i").select(names.alias("column_name"), "n_distinct", close.alias("within_bound"))


def pk_check(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_quantity") != 50, F.col("l_orderkey"))
    )
    orders = table(spark, sf_dir, "orders")
    return qc.check_primary_key(li, "lineitem", ["l_orderkey", "l_linenumber"]).unionByName(
        qc.check_primary_key(orders, "orders", ["o_orderkey"])
    )


def repeated_keys(spark, sf_dir) -> DataFrame:
    return qc.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _known_customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")


def _orders_with_gaps(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    )


def fk_orphans(spark, sf_dir) -> DataFrame:
    return op.orphans(
        _orders_with_gaps(spark, sf_dir), _known_customers(spark, sf_dir), ["o_custkey"], ["c_custkey"]
    )


def fk_orphan_rows(spark, sf_dir) -> DataFrame:
    return op.orphan_rows(
        _orders_with_gaps(spark, sf_dir), _known_customers(spark, sf_dir), ["o_custkey"], ["c_custkey"]
    ).select("o_orderkey", "o_custkey", "o_totalprice")


def fk_matched_rows(spark, sf_dir) -> DataFrame:
    return op.matched_rows(
        _orders_with_gaps(spark, sf_dir), _known_customers(spark, sf_dir), ["o_custkey"], ["c_custkey"]
    ).select("o_orderkey", "o_custkey", "o_totalprice")


def fk_orphans_prefiltered(spark, sf_dir) -> DataFrame:
    """Orphans of the urgent orders of some days; the many customers they do not refer to are ruled out before the shuffle."""
    few = _orders_with_gaps(spark, sf_dir).where((F.col("o_orderpriority") == "1-URGENT") & (F.dayofmonth("o_orderdate") == 1))
    return op.orphans(few, _known_customers(spark, sf_dir), ["o_custkey"], ["c_custkey"], prefilter=True)


def fk_matched_prefiltered(spark, sf_dir) -> DataFrame:
    """Orders of the customers of one nation; most other orders are ruled out before the shuffle."""
    few = table(spark, sf_dir, "customer").where("c_nationkey = 3")
    found = op.matched_rows(_orders_with_gaps(spark, sf_dir), few, ["o_custkey"], ["c_custkey"], prefilter=True)
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


def fk_unused_codes(spark, sf_dir) -> DataFrame:
    """The other direction of a foreign key: codes no row refers to."""
    nation, li = table(spark, sf_dir, "nation"), table(spark, sf_dir, "lineitem")
    return op.orphans(nation, li, ["n_nationkey"], ["l_linenumber"])


def fk_check(spark, sf_dir) -> DataFrame:
    key = ForeignKey(("o_custkey",), "customer", ("c_custkey",))
    return qc.check_foreign_key(
        _orders_with_gaps(spark, sf_dir), _known_customers(spark, sf_dir), "orders", key
    )


def unique_check(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        qc.check_unique(table(spark, sf_dir, "nation"), "nation", "n_name"),
        qc.check_unique(table(spark, sf_dir, "nation"), "nation", "n_regionkey"),
        qc.check_unique(table(spark, sf_dir, "lineitem"), "lineitem", "l_orderkey"),
    ])


def not_null_check(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return qc.check_not_null(orders, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])


def type_cast_contract(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") == 7, "seven").otherwise(F.concat("p_size", F.lit(".0"))).alias("p_size"),
        F.when(F.col("p_size") == 8, None).otherwise(F.col("p_retailprice").cast("string")).alias("price"),
        F.concat(F.lit("2020-01-"), F.col("p_size")).alias("day"),
        F.concat(F.lit("9007199254740993"), F.when(F.col("p_size") > 40, "9999")
                 .otherwise("")).alias("big"),
    )
    contract = StructType([
        StructField("p_size", IntegerType()), StructField("price", DoubleType()),
        StructField("day", StringType()), StructField("big", LongType()),
    ])
    return qc.failed_casts(part, contract)


def typed_values(spark, sf_dir) -> DataFrame:
    from starmart.sources import apply_schema

    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_size") == 7, "seven").otherwise(F.concat("p_size", F.lit(".9"))).alias("size"),
        F.concat(F.lit("900719925474"), F.lpad("p_partkey", 7, "0"), F.lit(".0")).alias("big"),
        F.col("p_retailprice").cast("string").alias("price"),
    )
    schema = StructType([
        StructField("id", LongType()), StructField("size", IntegerType()),
        StructField("big", LongType()), StructField("price", DoubleType()),
    ])
    return apply_schema(part, schema)


def schema_drift(spark, sf_dir) -> DataFrame:
    """Expected and found columns of orders, with the values each found column holds."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))
    )
    expected = StructType([
        StructField("o_orderkey", IntegerType()), StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()), StructField("o_orderdate", TimestampNTZType()),
        StructField("o_clerk", StringType()),
    ])
    held = op.profile(orders).select(
        "column_name", (F.col("n_rows") - F.col("n_missing")).alias("n_values")
    )
    return qc.schema_drift(orders.schema, expected, orders).join(held, "column_name", "left")


def row_balance(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.nullif("l_returnflag", F.lit("R"))
    )
    return qc.row_balance(li, ["l_orderkey", "l_linenumber"], ["l_returnflag"])


def quartiles(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q1, q2, q3 = op.exact_quantiles(li, "l_extendedprice", [0.25, 0.5, 0.75])
    return op.row_count(li).select(
        "n_rows", F.round(F.lit(q1), 6).alias("q1"), F.round(F.lit(q2), 6).alias("q2"),
        F.round(F.lit(q3), 6).alias("q3"),
    )


def _kept_profiles(spark, sf_dir, columns) -> DataFrame:
    """Profiles by return flag, stored when the flag R held other prices, then made anew for that flag."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.04)))
    before = li.withColumn("l_extendedprice", F.when(F.col("l_returnflag") == "R", F.lit(-1.0)).otherwise(F.col("l_extendedprice")))
    stored = stage(op.column_profiles(before, columns, ["l_returnflag"]), "profiles")
    return op.refreshed_profiles(stored, li.where("l_returnflag = 'R'"), columns, ["l_returnflag"])


def quartiles_kept(spark, sf_dir) -> DataFrame:
    """Exact quartiles that start from the brackets of kept profiles."""
    li = table(spark, sf_dir, "lineitem")
    profiles = stage(_kept_profiles(spark, sf_dir, ["l_extendedprice"]), "profiles")
    points = [0.25, 0.5, 0.75]
    known = op.bracketing(profiles, "l_extendedprice", points)
    q1, q2, q3 = op.exact_quantiles(li, "l_extendedprice", points, known=known)
    return op.row_count(li).select(
        "n_rows", F.round(F.lit(q1), 6).alias("q1"), F.round(F.lit(q2), 6).alias("q2"),
        F.round(F.lit(q3), 6).alias("q3"),
    )


def null_shares_kept(spark, sf_dir) -> DataFrame:
    found = op.null_shares(_kept_profiles(spark, sf_dir, ["l_extendedprice", "l_tax"]))
    return found.withColumn("pct_missing", F.round("pct_missing", 6))


def outliers_iqr(spark, sf_dir) -> DataFrame:
    return qc.outliers(table(spark, sf_dir, "events"), "value").select("event_id", "user_id", "value")


QUERIES = {
    f.__name__: f
    for f in (
        null_profile_pct, duplicate_row_count, year_range, row_counts, profile_columns, distinct_sketch_bound, pk_check,
        repeated_keys, fk_orphans, fk_orphan_rows, fk_matched_rows, fk_unused_codes, fk_orphans_prefiltered,
        fk_matched_prefiltered, quartiles_kept, null_shares_kept, fk_check, unique_check,
        not_null_check, type_cast_contract, typed_values, schema_drift, row_balance, quartiles,
        outliers_iqr,
    )
}

_GAPS = """
gaps as (
  select *, case when o_orderpriority <> '5-LOW' then o_custkey end as held from orders),
known as (select c_custkey from customer where c_mktsegment <> 'BUILDING')"""


def _profile_sql(columns: dict[str, str]) -> str:
    parts = []
    for i, (name, dtype) in enumerate(columns.items()):
        parts.append(f"""
select {i} as position, '{name}' as column_name, '{dtype}' as data_type, count(*) as n_rows,
       count(*) filter (where {name} is null) as n_missing,
       round(100.0 * cast(count(*) filter (where {name} is null) as double) / count(*), 6) as pct_missing,
       count(distinct {name}) as n_distinct, cast(min({name}) as varchar) as min_value,
       cast(max({name}) as varchar) as max_value
from customer""")
    return "\nunion all".join(parts)


ORACLES = {
    "distinct_sketch_bound": """
select 'o_orderkey' as column_name, count(distinct o_orderkey) as n_distinct, true as within_bound from orders
union all select 'o_custkey', count(distinct o_custkey), true from orders
union all select 'o_orderdate', count(distinct o_orderdate), true from orders""",
    "null_profile_pct": """
select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as n_missing,
       cast(0 as double) as pct_missing
from orders
union all
select 'o_orderstatus', count(*) filter (where o_orderstatus = 'F'),
       round(avg((o_orderstatus = 'F')::int) * 100, 6) from orders
union all
select 'o_totalprice', count(*) filter (where o_orderpriority = '1-URGENT'),
       round(avg((o_orderpriority = '1-URGENT')::int) * 100, 6) from orders""",
    "duplicate_row_count": """
select cast(count(*) - count(distinct (l_partkey, l_returnflag, l_quantity)) as bigint) as n_duplicates
from lineitem""",
    "year_range": """
select cast(min(year(o_orderdate)) as int) as min_value, cast(max(year(o_orderdate)) as int) as max_value
from orders""",
    "row_counts": "\nunion all\n".join(
        f"select '{n}' as table_name, count(*) as n_rows from {n}"
        for n in ("orders", "lineitem", "events", "customer", "documents", "pages")
    ),
    "profile_columns": _profile_sql({
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
        "c_mktsegment": "string",
    }),
    "pk_check": """
with keyed as (
  select case when l_quantity <> 50 then l_orderkey end as k, l_linenumber as n from lineitem),
found as (
  select 'lineitem' as table_name, 'primary_key_unique' as check_name,
         'l_orderkey,l_linenumber' as column_name,
         (select count(*) from (select k, n from keyed where k is not null group by k, n
                                having count(*) > 1)) as value
  union all
  select 'lineitem', 'primary_key_not_null', 'l_orderkey,l_linenumber',
         (select count(*) from keyed where k is null)
  union all
  select 'orders', 'primary_key_unique', 'o_orderkey',
         (select count(*) from (select o_orderkey from orders group by 1 having count(*) > 1))
  union all
  select 'orders', 'primary_key_not_null', 'o_orderkey',
         (select count(*) from orders where o_orderkey is null))
select *, case when value = 0 then 'ok' else 'failed' end as status from found""",
    "repeated_keys": """
select l_orderkey, l_linenumber, count(*) as n_rows
from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "fk_orphans": f"""
with {_GAPS}
select held as o_custkey, count(*) as n_rows from gaps
where held is not null and not exists (select 1 from known where c_custkey = held)
group by held""",
    "fk_orphan_rows": f"""
with {_GAPS}
select o_orderkey, held as o_custkey, o_totalprice from gaps
where held is not null and not exists (select 1 from known where c_custkey = held)""",
    "fk_matched_rows": f"""
with {_GAPS}
select o_orderkey, held as o_custkey, o_totalprice from gaps
where exists (select 1 from known where c_custkey = held)""",
    "fk_orphans_prefiltered": f"""
with {_GAPS}
select held as o_custkey, count(*) as n_rows from gaps
where held is not null and o_orderpriority = '1-URGENT' and day(o_orderdate) = 1
  and not exists (select 1 from known where c_custkey = held)
group by held""",
    "fk_matched_prefiltered": f"""
with {_GAPS}
select o_orderkey, held as o_custkey, o_totalprice from gaps
where exists (select 1 from customer where c_custkey = held and c_nationkey = 3)""",
    "null_shares_kept": """
select 'l_extendedprice' as column_name, count(*) as n_rows, count(*) filter (where l_extendedprice is null) as n_missing,
       0.0::double as pct_missing from lineitem
union all
select 'l_tax', count(*), count(*) filter (where l_tax = 0.04),
       round(count(*) filter (where l_tax = 0.04) * 100.0::double / count(*), 6) from lineitem""",
    "fk_unused_codes": """
select n_nationkey, count(*) as n_rows from nation
where n_nationkey not in (select l_linenumber from lineitem) group by n_nationkey""",
    "fk_check": f"""
with {_GAPS}
select 'orders' as table_name, 'foreign_key' as check_name, 'o_custkey->customer' as column_name,
       count(*) as value, case when count(*) = 0 then 'ok' else 'failed' end as status
from gaps where held is not null and not exists (select 1 from known where c_custkey = held)""",
    "unique_check": """
with found as (
  select 'nation' as table_name, 'n_name' as column_name,
         (select count(*) from (select n_name from nation group by 1 having count(*) > 1)) as value
  union all
  select 'nation', 'n_regionkey',
         (select count(*) from (select n_regionkey from nation group by 1 having count(*) > 1))
  union all
  select 'lineitem', 'l_orderkey',
         (select count(*) from (select l_orderkey from lineitem group by 1 having count(*) > 1)))
select table_name, 'unique' as check_name, column_name, value,
       case when value = 0 then 'ok' else 'failed' end as status
from found""",
    "not_null_check": """
with found as (
  select 'o_orderkey' as column_name, count(*) filter (where o_orderkey is null) as value from orders
  union all
  select 'o_orderstatus', count(*) filter (where o_orderstatus = 'F') from orders
  union all
  select 'o_orderpriority', count(*) filter (where o_orderpriority = '5-LOW') from orders)
select 'orders' as table_name, 'not_null' as check_name, column_name, value,
       case when value = 0 then 'ok' else 'failed' end as status
from found""",
    "type_cast_contract": """
select 'p_size' as column_name, 'int' as data_type, count(*) as n_values,
       count(*) filter (where p_size = 7) as n_failed from part
union all
select 'price', 'double', count(*) filter (where p_size <> 8), 0 from part
union all
select 'day', 'string', count(*), 0 from part
union all
select 'big', 'bigint', count(*), count(*) filter (where p_size > 40) from part""",
    "typed_values": """
select p_partkey as id, case when p_size <> 7 then p_size end as size,
       cast('900719925474' || lpad(cast(p_partkey as varchar), 7, '0') as bigint) as big,
       p_retailprice as price
from part""",
    "schema_drift": """
select column_name, expected_type, found_type, status,
       case column_name
         when 'o_clerk' then null
         when 'o_orderstatus' then (select count(*) from orders where o_orderstatus <> 'F')
         else (select count(*) from orders) end as n_values
from (values
  ('o_orderkey', 'int', 'bigint', 'retyped'),
  ('o_custkey', 'bigint', 'bigint', 'ok'),
  ('o_orderstatus', 'string', 'string', 'ok'),
  ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'ok'),
  ('o_clerk', 'string', null, 'missing'),
  ('o_totalprice', null, 'double', 'extra'),
  ('o_orderpriority', null, 'string', 'extra')
) as t(column_name, expected_type, found_type, status)""",
    "row_balance": """
with kept as (
  select l_orderkey, l_linenumber, nullif(l_returnflag, 'R') as flag from lineitem),
survivors as (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber order by (flag is null)::int, flag) as rn
  from kept),
counted as (
  select (select count(*) from kept) as rows_in,
         count(*) filter (where rn > 1) as rows_duplicate,
         count(*) filter (where rn = 1 and flag is null) as rows_missing,
         count(*) filter (where rn = 1 and flag is not null) as rows_out
  from survivors)
select *, rows_in - rows_duplicate - rows_missing = rows_out as balanced from counted""",
    "quartiles": """
select count(*) as n_rows, round(quantile_cont(l_extendedprice, 0.25), 6) as q1,
       round(quantile_cont(l_extendedprice, 0.5), 6) as q2,
       round(quantile_cont(l_extendedprice, 0.75), 6) as q3
from lineitem""",
    "quartiles_kept": """
select count(*) as n_rows, round(quantile_cont(l_extendedprice, 0.25), 6) as q1,
       round(quantile_cont(l_extendedprice, 0.5), 6) as q2,
       round(quantile_cont(l_extendedprice, 0.75), 6) as q3
from lineitem""",
    "outliers_iqr": """
with q as (
  select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
select event_id, user_id, value from events, q
where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)""",
}
