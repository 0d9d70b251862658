"""Row, key, profile and join operators on small frames and under random input."""

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from starmart import operators as op
from starmart.operators import quantiles as quantile_module
from starmart.operators.keys import tagged_counts
from starmart.operators.rows import dedupe_in_ranges, frequent_keys
from starmart.sinks import stage

FEW = settings(
    max_examples=6, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
SCHEMA = "k int, a int, b string"
small = st.one_of(st.none(), st.integers(0, 3))
rows = st.lists(
    st.tuples(small, small, st.one_of(st.none(), st.sampled_from("xyz"))), min_size=0, max_size=60
)


def nulls_last(value):
    return (value is None, value if value is not None else 0)


def text_nulls_last(value):
    return (value is None, value or "")


@FEW
@given(rows, st.integers(1, 7))
def test_dedupe_keeps_the_first_row_of_each_key(spark, data, partitions):
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    found = {tuple(r) for r in op.dedupe(df, "k").collect()}
    best = {}
    for row in sorted(data, key=lambda r: (nulls_last(r[1]), text_nulls_last(r[2]))):
        best.setdefault(row[0], row)
    assert found == set(best.values())
    copied = df.unionByName(df)
    assert {tuple(r) for r in op.dedupe(copied, "k").collect()} == found
    # an extra distinct changes nothing
    assert {tuple(r) for r in op.dedupe(df.distinct(), "k").collect()} == found


@FEW
@given(rows)
def test_preferring_complete_rows_loses_no_key(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    after = op.drop_missing(op.dedupe(df, "k", prefer_complete=["a", "b"]), ["a", "b"])
    before = op.dedupe(op.drop_missing(df, ["a", "b"]), "k")
    assert sorted(map(tuple, after.collect()), key=str) == sorted(map(tuple, before.collect()), key=str)


@FEW
@given(rows)
def test_missing_counts_add_up(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    report = {r.column_name: r.n_missing for r in op.missing_report(df, ["k", "a", "b"]).collect()}
    kept = op.drop_missing(df, ["k", "a", "b"])
    assert kept.filter("k is null or a is null or b is null").count() == 0
    assert len(data) - sum(report.values()) == kept.count()
    left = [r for r in data if r[0] is not None]
    assert report["k"] == len(data) - len(left)
    assert report["a"] == sum(r[1] is None for r in left)


@FEW
@given(rows)
def test_duplicate_rows_and_report(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert op.duplicate_rows(df).first()[0] == len(data) - len(set(data))
    before, removed, after = op.dedupe_report(df, "k").first()
    keys = len({r[0] for r in data})
    assert (before, removed, after) == (len(data), len(data) - keys, keys)


@FEW
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80, unique=True))
def test_dense_ids_do_not_depend_on_partitioning(spark, keys):
    df = spark.createDataFrame([(k, f"t{k}") for k in keys], "k int, t string")
    want = {k: i for i, k in enumerate(sorted(keys))}
    for partitions in (1, 5):
        got = op.dense_id(df.repartition(partitions), "id", ["k"]).collect()
        assert {r.k: r.id for r in got} == want
    text = op.dense_id(df, "id", ["t"]).collect()
    assert {r.t: r.id for r in text} == {t: i for i, t in enumerate(sorted(f"t{k}" for k in keys))}


def test_dense_ids_of_equal_rows(spark):
    """Two thirds of the rows are copies of one: each gets an id of its own, in order."""
    df = spark.createDataFrame([(1, "a")] * 200 + [(k, "b") for k in range(-50, 50)], "k int, t string")
    found = op.dense_id(df.repartition(6), "id", ["k"]).collect()
    assert sorted(r.id for r in found) == list(range(300))
    ordered = [(r.k, r.t) for r in sorted(found, key=lambda r: r.id)]
    assert ordered == sorted(ordered)


def test_climate_never_repeats_an_arrival(spark):
    fact = spark.createDataFrame([(1, "ABC", 5), (2, "XXX", 5), (3, "ABC", 6)], "uid int, city_code string, month int")
    ports = spark.createDataFrame([("ABC", "SAMPLETOWN, XX   ")], "code string, city string")
    climate = spark.createDataFrame(
        [("Sampletown", "US", 5, 10.0, 1), ("SAMPLETOWN", "FR", 5, 20.0, 3), ("Sampletown", "US", 6, None, 0)],
        "city string, country string, month int, avg_temperature double, n_days long",
    )
    found = op.climate_by_arrival(fact, ports, climate).sort("uid").collect()
    assert [(r.uid, r.usual_temperature) for r in found] == [(1, 17.5), (2, None), (3, None)]


def test_known_counts_save_a_pass_over_the_tags(spark):
    staged = stage(op.tag_rows(spark.range(100).repartition(4).withColumn("ok", F.col("id") < 70), [F.desc("ok"), "id"]), "tagged")
    counts = stage(tagged_counts(staged, F.count_if("ok").alias("__n")), "counts")
    good = staged.where("ok")
    given, found = op.number_staged(good, "n", counts=counts), op.number_staged(good, "n")
    assert sorted(given.collect()) == sorted(found.collect()) and {r.n for r in given.collect()} == set(range(70))
    place = staged.inputFiles()[0].rsplit("/", 1)[0].rsplit("/", 1)[1]
    reads = [d._jdf.queryExecution().executedPlan().toString().count(place) for d in (given, found)]
    assert reads[0] * 2 == reads[1]


def test_dense_ids_on_an_empty_frame(spark):
    df = spark.createDataFrame([], "k int")
    assert op.dense_id(df, "id", ["k"]).count() == 0


def test_sparse_ids_are_unique(spark):
    df = op.sparse_id(spark.range(1000).repartition(7), "id")
    assert df.select("id").distinct().count() == 1000


def test_require_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, t string")
    with pytest.raises(ValueError, match="1 repeated"):
        op.require_unique(df, "k")
    with pytest.raises(ValueError, match="1 rows without"):
        op.require_unique(df, ["k", "t"])
    assert op.require_unique(df.filter("t is not null"), ["k", "t"]).count() == 2


def quantile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@FEW
@given(
    st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=80),
    st.lists(st.floats(0, 1), min_size=1, max_size=3),
)
def test_quantiles_are_exact(spark, values, probabilities):
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "v double")
    assert op.exact_quantiles(df, "v", probabilities) == [quantile(values, p) for p in probabilities]


def test_quantiles_cut_a_wide_bracket(spark, monkeypatch):
    """A bracket with too many values for one task is cut down, even beside a hot value."""
    monkeypatch.setattr(quantile_module, "ORDERED_VALUES", 20)
    hot = [500.0] * 4000
    spread = [float(i * 7919 % 3001) for i in range(3001)]
    values = hot + spread
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    points = [0.0, 0.05, 0.07, 0.5, 0.93, 1.0]
    found = op.exact_quantiles(df, "v", points, accuracy=10)
    assert found == [quantile(values, p) for p in points]
    assert statistics.median(values) == op.exact_quantiles(df, "v", [0.5], accuracy=10)[0]


def test_quantiles_of_nothing(spark):
    assert op.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


def test_filters(spark):
    df = spark.createDataFrame([(1, "US"), (2, None), (3, "CA")], "i int, c string")
    assert [r.i for r in op.equal_to(df, "c", "US").collect()] == [1]
    assert [r.i for r in op.equal_to(df, "c", "US", "CA").sort("i").collect()] == [1, 3]
    assert [r.i for r in op.in_range(df, "i", 1, 3).sort("i").collect()] == [1, 2]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Number of Veterans", "Foreign-born"])
    assert op.normalise_names(df).columns == ["number_of_veterans", "foreign_born"]
    with pytest.raises(ValueError):
        op.normalise_names(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))
    assert op.rename(df, {"Foreign-born": "x", "none": "y"}).columns == ["Number of Veterans", "x"]


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, None), (None, "a"), (2.0, "b")], "d double, t string")
    for exact in (True, False):
        found = {r.column_name: r for r in op.profile(df, exact_distinct=exact).collect()}
        assert (found["d"].n_rows, found["d"].n_missing, found["d"].pct_missing) == (4, 2, 50.0)
        assert (found["t"].n_missing, found["t"].n_distinct) == (1, 2)
        assert (found["t"].min_value, found["t"].max_value) == ("a", "b")
    assert op.sparse_columns(df, 30.0) == ["d"]
    assert op.drop_sparse(df, 30.0, keep=["d"]).columns == ["d", "t"]
    assert op.drop_sparse(df, 30.0).columns == ["t"]


def test_profile_computes_what_is_selected(spark):
    df = spark.range(5).selectExpr("nullif(id, 2) as a", "cast(id as string) as b")
    counted = op.profile(df).select("column_name", F.col("n_rows") - F.col("n_missing"))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "count(" in plan and "min(" not in plan and "approx_count_distinct(" not in plan
    assert sorted(map(tuple, counted.collect())) == [("a", 4), ("b", 5)]
    assert [tuple(r) for r in op.profile(df).orderBy("position").collect()] == [
        (0, "a", "bigint", 5, 1, 20.0, 4, "0", "4"), (1, "b", "string", 5, 0, 0.0, 5, "0", "4"),
    ]


def test_profile_of_no_rows(spark):
    found = op.profile(spark.createDataFrame([], "a int")).first()
    assert (found.n_rows, found.n_missing, found.pct_missing) == (0, 0, None)


def test_country_codes_match_whatever_their_notation(spark):
    personal = spark.createDataFrame(
        [(1, "101.0", "102"), (2, "999", None)], "uid int, citizen_country string, residence_country string"
    )
    codes = spark.createDataFrame([("101", "FREDONIA"), ("102", "SYLVANIA")], "code string, country string")
    found = op.enrich_countries(personal, codes).sort("uid").collect()
    assert (found[0].citizen_country_name, found[0].residence_country_name) == ("FREDONIA", "SYLVANIA")
    assert (found[1].citizen_country_name, found[1].residence_country_name) == (None, None)
    assert len(found) == 2


def test_places_match_whatever_their_case(spark):
    left = spark.createDataFrame([("Springfield ", "Ohio", 1), ("X", "Y", 2)], "city string, state string, n int")
    right = spark.createDataFrame([("SPRINGFIELD", "OHIO", 33.5)], "city string, state string, median_age double")
    found = op.join_places(left, right).collect()
    assert [(r.city, r.city_key, r.n, r.median_age) for r in found] == [("Springfield ", "SPRINGFIELD", 1, 33.5)]
    assert op.join_places(left, right, how="left").count() == 2


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert [tuple(r) for r in op.orphans(child, parent, ["k"], ["p"]).collect()] == [(2, 2)]
    assert op.orphan_rows(child, parent, ["k"], ["p"]).count() == 2
    assert op.matched_rows(child, parent, ["k"], ["p"]).count() == 1


def test_city_of_port(spark):
    df = spark.createDataFrame([("SAMPLETOWN, XX   ",), ("No comma ",), (None,)], "c string")
    assert [r[0] for r in df.select(op.city_of_port("c")).collect()] == ["SAMPLETOWN", "NO COMMA", None]


def test_rows_are_reduced_in_ranges_of_the_key(spark):
    rows = [(k, v % 3 if v % 4 else None, f"t{v % 5}") for v in range(40) for k in (None, -7, 3, 8, v, 1000 - v)]
    df = spark.createDataFrame(rows, "k long, a int, b string").repartition(4)
    want = sorted(op.dedupe(df, "k", prefer_complete=["k", "a"]).collect(), key=str)
    for frequent in ((), (3, -7), (12345,)):
        found = dedupe_in_ranges(df, "k", frequent, prefer_complete=["k", "a"])
        # only the rows of frequent keys are dealt by hash; the others meet, and are sorted, in one shuffle
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(found.collect(), key=str) == want
        assert plan.count("Exchange range") == plan.count("Exchange hash") == 1
        assert "row_number(), 1, Partial" in plan.split("Exchange hash")[1]
    parts = found.select("k", F.spark_partition_id().alias("p")).groupBy("p").agg(F.min("k").alias("low"), F.max("k").alias("high")).sort("low").collect()
    parts = [p for p in parts if p.low is not None]
    assert all(a.high < b.low for a, b in zip(parts, parts[1:], strict=False))


def test_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr("starmart.operators.rows._FEW", 50)
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
    assert frequent_keys(df, "k", 4000) == [5]
    assert frequent_keys(df.limit(0), "k", 0) == frequent_keys(df.where("k <> 5"), "k", 50) == []
