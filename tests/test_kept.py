"""Kept profiles and Bloom prefilters: equal results, fewer scans, fewer rows shuffled."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starmart import operators as op
from starmart.operators import prefilter, quantiles


def exact(values, p):
    values, at = sorted(values), (len(values) - 1) * p
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


POINTS = [0.0, 0.1, 0.5, 0.9, 1.0]


def test_quantiles_from_kept_profiles_after_a_refresh(spark, monkeypatch):
    rng = random.Random(4)
    given = [(g, rng.choice([rng.gauss(g, 1), 5.0, None, math.nan])) for g in range(4) for _ in range(800)] + [(None, 7.0)]
    schema = "g int, v double"
    stored = op.column_profiles(spark.createDataFrame(given, schema), ["v"], ["g"])
    # group 1 gets other rows, the rows without a group are made anew, group 2 loses all of its rows
    changed = [(1, rng.gauss(50, 9)) for _ in range(500)] + [(None, 8.0), (None, None)]
    now = [r for r in given if r[0] not in (1, 2, None)] + changed
    touched = spark.createDataFrame([(1,), (2,), (None,)], "g int")
    profiles = op.refreshed_profiles(stored, spark.createDataFrame(changed, schema), ["v"], ["g"], touched)
    known = op.bracketing(profiles, "v", POINTS)
    values = [v for _, v in now if v is not None and not math.isnan(v)]
    assert (known.n, known.low, known.high) == (len(values), min(values), max(values))
    monkeypatch.setattr(quantiles, "_sketched", None)  # no scan for brackets
    rows = spark.createDataFrame(now, schema)
    assert op.exact_quantiles(rows, "v", POINTS, known=known) == pytest.approx([exact(values, p) for p in POINTS], rel=1e-12)
    share = op.null_shares(profiles).first()
    assert (share.n_rows, share.n_missing) == (len(now), len(now) - len(values))


def test_profiles_of_nothing(spark):
    none = spark.createDataFrame([(1, None, None), (2, None, 3)], "g int, v double, w int")
    profiles = op.column_profiles(none, ["v", "w"], ["g"])
    assert op.exact_quantiles(none, "v", POINTS, known=op.bracketing(profiles, "v", POINTS)) == [None] * 5
    assert op.exact_quantiles(none, "w", POINTS, known=op.bracketing(profiles, "w", POINTS)) == [3.0] * 5
    assert op.bracketing(op.column_profiles(none.limit(0), ["v"], ["g"]), "v", POINTS).n == 0


def test_brackets_that_miss_are_moved(spark):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    wrong = op.Bracketing(1000, 0.0, 999.0, 0.008, {p + s: 3.0 for p in POINTS for s in (-0.008, 0.008)})
    assert op.exact_quantiles(rows, "v", POINTS, known=wrong) == pytest.approx([exact(range(1000), p) for p in POINTS])


def test_a_filter_holds_all_keys_and_few_others(spark):
    held = op.key_filter(spark.range(0, 40_000, 4).select(F.col("id").cast("int").alias("k")), ["k"])
    passed = {r.k for r in held.passing(spark.range(40_000).withColumnRenamed("id", "k"), ["k"]).collect()}
    assert set(range(0, 40_000, 4)) <= passed and len(passed) < 10_000 + 0.02 * 30_000
    assert op.key_filter(spark.range(0).withColumnRenamed("id", "k"), ["k"]).passing(spark.range(9).toDF("k"), ["k"]).count() == 0


def test_prefiltered_joins_equal_plain_ones(spark, monkeypatch):
    child = spark.createDataFrame([(i % 60 if i % 7 else None, f"t{i % 5}" if i % 11 else None, i) for i in range(600)], "a int, b string, x int")
    parent = spark.range(30, 5000).select("id", F.concat(F.lit(" T"), F.col("id") % 4).alias("t")).unionByName(
        spark.createDataFrame([(None, None), (31, None)], "id long, t string"))

    def both(work):
        found = [sorted(map(str, work(p).collect())) for p in (False, True)]
        assert found[0] == found[1] and found[0]

    both(lambda p: op.orphans(child, parent, ["a"], ["id"], prefilter=p))
    both(lambda p: op.orphans(child, parent, ["a", "b"], ["id", "t"], normalised=False, prefilter=p))
    both(lambda p: op.orphans(child, parent, ["b"], ["t"], normalised=True, prefilter=p))
    both(lambda p: op.matched_rows(child, parent, ["a"], ["id"], prefilter=p))
    # keys whose types hash differently are left to the join
    both(lambda p: op.matched_rows(child.withColumn("a", F.col("a").cast("double")), parent, ["a"], ["id"], prefilter=p))
    # too many keys for a filter
    monkeypatch.setattr(prefilter, "WORDS", 1)
    assert op.key_filter(parent, ["id"]) is None
    both(lambda p: op.matched_rows(child, parent, ["a"], ["id"], prefilter=p))


def test_few_rows_are_shuffled(spark):
    """Rows written by the shuffle of the large side, as the plan's metrics have them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        few = spark.range(0, 50_000, 500).withColumnRenamed("id", "k")
        many = spark.range(50_000).withColumnRenamed("id", "k")
        found = op.matched_rows(many, few, ["k"], ["k"], prefilter=True)
        plan = found._jdf.queryExecution().executedPlan()
        assert found._jdf.queryExecution().executedPlan().executeCollect().__len__() == 100
        written, todo = [], [plan]
        while todo:
            node = todo.pop()
            if "shuffleRecordsWritten" in str(node.metrics().keys()):
                written.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
        assert written and max(written) < 1500
    finally:
        for name in conf:
            spark.conf.unset(name)
