"""Mergeable distinct counts: bound, union, refresh of single groups, NULLs."""

from pyspark.sql import functions as F

from starmart import operators as op


def estimates(df, columns):
    return op.estimated_distinct(df, columns).first()


def test_unions_are_within_the_bound_whatever_the_groups(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("k"), F.concat(F.lit("t"), F.col("id") % 5000).alias("t"), (F.col("id") % 700 / 7).alias("x"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("part"), F.lit(None).cast("string").alias("none"),
    )
    columns = ["k", "t", "x", "none"]
    parts = op.distinct_sketches(rows.repartition(5), columns, ["part"])
    other = op.distinct_sketches(rows.withColumn("g", F.col("k") % 7), columns, ["g"])
    whole = op.distinct_sketches(rows.coalesce(1), columns)
    assert parts.count() == 3
    for one in (parts, other, whole):
        for found, exact in zip(estimates(one, columns), (20_000, 5000, 700, 0), strict=True):
            assert abs(found - exact) <= 0.05 * exact
    by_part = {r.part: r.k for r in op.estimated_distinct(parts, ["k"], ["part"]).collect()}
    assert set(by_part) == {None, 1, 2} and all(abs(n - 20_000) <= 1000 for n in by_part.values())


def test_refresh_makes_touched_groups_anew(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k long, part string")
    stored = op.distinct_sketches(rows, ["k"], ["part"])
    # group b and the one without a name are read again, a is not
    again = spark.createDataFrame([(3, "b"), (5, "b"), (6, None), (7, None)], "k long, part string")
    now = op.refreshed_sketches(stored, again, ["k"], ["part"])
    assert {r.part: r.k for r in op.estimated_distinct(now, ["k"], ["part"]).collect()} == {"a": 2, "b": 2, None: 2}
    assert estimates(now, ["k"]).k == 6
    assert estimates(op.distinct_sketches(rows.limit(0), ["k"]), ["k"]).k in (0, None)
