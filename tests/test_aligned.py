"""Tables in buckets of one key: joins and groups without a shuffle, refreshes by parts, refused parts."""

import random

import pytest
from pyspark.sql import functions as F
from test_mart import arrival, arrival_file

from starmart import analytics as an
from starmart.contracts import CONTRACTS
from starmart.plans import run
from starmart.sinks import UnevenBuckets, append_aligned, layout_of, read_aligned, write_aligned
from starmart.sources import read_table

ARRIVALS = ["fact_immigration", "dim_immigration_personal", "dim_immigration_airline"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_analyses_of_a_refreshed_mart_do_not_shuffle_by_the_arrival_number(spark, tmp_path, no_broadcast):
    dst = str(tmp_path / "mart")

    def load(lines, mode, **options):
        source = arrival_file(tmp_path, f"{random.random()}.csv", lines)
        return run(spark, "", dst, ARRIVALS, paths={"immigration": source}, mode=mode, keep_steps=True, **options)

    load([arrival(i, "CA") for i in range(60)], "overwrite", aligned=4)
    built = load([arrival(i, "NY", "9.0") for i in range(50, 80)], "refresh")
    assert all(b.balanced for b in built.values()) and built["fact_immigration"].counts["written"] == 30
    assert built["fact_immigration"].change.replaced.count() == 10
    load([arrival(i, "NY", "9.0") for i in range(50, 80)], "refresh")  # brought in twice
    fact, personal, airline = (read_table(spark, f"{dst}/{n}", schema=CONTRACTS[n].schema) for n in ARRIVALS)
    rows = {r.uid: r for r in fact.collect()}
    assert sorted(rows) == list(range(80)) == sorted(r.immigration_id for r in rows.values())
    assert all(r.immigration_id == u and (r.state_code == "NY") == (u >= 50) and (r["mode"] == 9) == (u >= 50) for u, r in rows.items())
    assert fact.join(personal, "uid").join(airline, "uid").count() == fact.join(personal, "uid").count() == 80
    for joined in (fact.join(personal, "uid"), fact.groupBy("uid").count(), fact.join(personal, "uid").join(airline, "uid")):
        assert "Exchange" not in plan(joined)
    ages = plan(an.age_distribution(fact, personal))
    assert "hashpartitioning(uid" not in ages and "SelectedBucketsCount: 4 out of 4" in ages
    assert "hashpartitioning(uid" not in plan(an.arrivals_by_origin(fact, personal, spark.createDataFrame([], "code string, country string")))
    # written anew, it stays in buckets, and is one part again
    load([arrival(7, "CA")], "overwrite")
    layout = layout_of(spark, f"{dst}/fact_immigration")
    assert (layout.buckets, len(layout.parts), layout.rows) == (4, 1, 1)
    assert [r.uid for r in read_table(spark, f"{dst}/fact_immigration").collect()] == [7]


def test_a_refresh_shuffles_the_batch_alone(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "t")
    write_aligned(spark.range(500).select("id", (F.col("id") * 2).alias("v")), path, "id", 8, "id")
    stored = read_aligned(spark, path, spark.range(1).select("id", F.col("id").alias("v")).schema)
    shuffles = plan(stored.join(spark.range(5), "id", "left_semi")).count("Exchange")
    assert shuffles == 1


def test_rows_of_a_part_never_entered_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select("id", F.lit("a").alias("v"))
    assert write_aligned(rows, path, "id", 4, "id") == 100
    layout = layout_of(spark, path)
    name = [t.name for t in spark.catalog.listTables() if t.name.startswith("aligned_")]
    for t in name:  # what a run that dies before the entry leaves behind
        if spark.table(t).inputFiles()[0].startswith(f"file://{path}/"):
            spark.range(5).select("id", F.lit("lost").alias("v"), F.lit("00000001-x").alias("p")).write.insertInto(t)
    assert append_aligned(spark.range(95, 105).select("id", F.lit("b").alias("v")), path, "id") == 10
    now = read_aligned(spark, path, rows.schema)
    assert {r.v: r["n"] for r in now.groupBy("v").agg(F.count("*").alias("n")).collect()} == {"a": 95, "b": 10}
    assert layout.top_id == 99 and layout_of(spark, path).top_id == 104
    # a session that has not seen the table
    spark.sql("DROP TABLE " + " ".join(t for t in name if spark.table(t).inputFiles()[0].startswith(f"file://{path}/")))
    assert read_aligned(spark, path, rows.schema).count() == 105


def test_hot_and_missing_keys_are_refused(spark, tmp_path, monkeypatch):
    from starmart.sinks import aligned

    monkeypatch.setattr(aligned, "FEW", 50)
    path = str(tmp_path / "t")
    hot = spark.range(1000).select(F.when(F.col("id") > 600, F.col("id")).otherwise(F.lit(1)).alias("id"))
    with pytest.raises(UnevenBuckets, match="of 1000 rows"):
        write_aligned(hot, path, "id", 16)
    with pytest.raises(UnevenBuckets, match="2 rows lack"):
        write_aligned(spark.createDataFrame([(1,), (None,), (None,)], "id long"), path, "id", 4)
    assert layout_of(spark, path) is None
    assert write_aligned(spark.range(0), path, "id", 4) == 0
    assert read_aligned(spark, path, spark.range(0).schema).count() == 0
