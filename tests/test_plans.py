"""The physical plans the operators must keep."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starmart import analytics as an, operators as op, quality as qc
from starmart.plans import RECIPES
from starmart.plans.mart import _finish, _reduce, typed_columns

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SMALL}/lineitem.parquet")


def test_dedupe_reduces_before_its_only_shuffle(lineitem):
    plan = plan_of(op.dedupe(lineitem, ["l_orderkey", "l_linenumber"]))
    assert plan.count("Exchange") == 1
    assert "row_number(), 1, Partial" in plan.split("Exchange")[1]


def test_every_table_plan_stays_native(spark):
    for recipe in RECIPES.values():
        raw = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in recipe.columns))
        done = _finish(_reduce(typed_columns(recipe, raw, "lenient"), recipe), recipe)
        plan = plan_of(done)
        assert "Python" not in plan and "Arrow" not in plan
        assert plan.count("Exchange") == 1, recipe.name


def test_a_table_reads_only_its_columns(spark, tmp_path):
    recipe = replace(RECIPES["dim_immigration_airline"])
    columns = {c for r in RECIPES.values() if r.source == "immigration" for c in r.columns}
    path = str(tmp_path / "landed")
    spark.range(5).select(*[F.lit("1").alias(c) for c in sorted(columns)]).write.parquet(path)
    plan = plan_of(typed_columns(recipe, spark.read.parquet(path), "lenient"))
    schema = plan.split("ReadSchema: ")[1]
    assert "arrdate" not in schema and "admnum" in schema


def test_day_numbers_are_parsed_once(spark):
    recipe = RECIPES["fact_immigration"]
    raw = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in recipe.columns))
    plan = plan_of(typed_columns(recipe, raw, "lenient"))
    assert plan.count("RLIKE(arrdate") == plan.count("upper(arrdate") == 1


def test_small_code_tables_are_broadcast_by_size(spark, lineitem):
    codes = spark.read.parquet(f"{SMALL}/nation.parquet").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )
    df = lineitem.withColumn("c", F.col("l_linenumber").cast("string"))
    assert "BroadcastHashJoin" in plan_of(op.lookup(df, codes, "c", "label", "name"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(op.lookup(df, codes, "c", "label", "name"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_destinations_count_before_the_join(spark, lineitem):
    fact = lineitem.select(F.col("l_suppkey").cast("string").alias("state_code"))
    codes = spark.createDataFrame([("1", "ONE")], "code string, state string")
    plan = plan_of(an.primary_destinations(fact, codes))
    assert "TakeOrderedAndProject" in plan
    join = plan.index("Join")
    assert "HashAggregate" in plan[join:]


def test_reports_shuffle_no_rows(lineitem):
    """One-pass reports exchange one partial row per task."""
    for df in (op.missing_report(lineitem, ["l_tax"]), op.profile(lineitem),
               qc.check_not_null(lineitem, "t", ["l_tax"]), qc.failed_casts(lineitem, lineitem.schema)):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan
        assert "partial_" in plan


def test_orphans_meet_as_distinct_keys(spark, lineitem):
    parent = spark.read.parquet(f"{SMALL}/orders.parquet")
    plan = plan_of(op.orphans(lineitem, parent, ["l_orderkey"], ["o_orderkey"]))
    assert "LeftAnti" in plan and "partial_count" in plan
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_outlier_limits_reach_the_scan(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    plan = plan_of(qc.outliers(events, "value"))
    assert "PushedFilters: [Or(LessThan(value" in plan


def test_no_cross_joins(spark, lineitem):
    codes = spark.read.parquet(f"{SMALL}/nation.parquet").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("country")
    )
    fact = lineitem.select(F.col("l_orderkey").alias("uid"), F.year("l_shipdate").alias("year"))
    personal = lineitem.select(F.col("l_orderkey").alias("uid"), F.col("l_suppkey").alias("citizen_country"))
    temperature = lineitem.select(
        F.col("l_returnflag").alias("country"), F.year("l_shipdate").alias("year"),
        F.col("l_tax").alias("avg_temperature"),
    )
    plan = plan_of(an.warming_and_origins(temperature, fact, personal, codes))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bucketed_tables_join_without_a_shuffle(spark):
    from spark_checks import QUERIES

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["bucketed_join"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_arrivals_are_not_shuffled_for_the_climate(spark):
    from spark_checks import QUERIES

    plan = plan_of(QUERIES["climate_join"](spark, SMALL))
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hash" not in plan


def test_orphan_rows_are_not_shuffled(spark, lineitem):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").filter("o_orderstatus <> 'F'")
    plan = plan_of(op.orphan_rows(lineitem, orders, ["l_orderkey"], ["o_orderkey"]))
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan
