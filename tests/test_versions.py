"""Tables kept as versions: pruning by key ranges, publishing by a pointer, and the queries over them."""

import random

import pytest
from pyspark.sql import functions as F
from test_mart import arrival, arrival_file

from starmart.contracts import FACT_IMMIGRATION
from starmart.plans import mart, run
from starmart.sinks import versions


def rows(n, start=0, batch=0):
    states = ["CA", "NY", "O H:1", "", "a+b %"]
    return [arrival(i, states[i % 5] if i % 3 else "CA", f"{batch + 1}.0") for i in range(start, start + n)]


def contents(spark, path):
    fact = versions.read_files(spark, path, FACT_IMMIGRATION.schema)
    return sorted(fact.select("immigration_id", "uid", F.coalesce("state_code", F.lit("")), "mode").collect())


@pytest.fixture
def fact(spark, tmp_path):
    dst = str(tmp_path / "mart")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # some files for few rows

    def load(lines, mode="refresh", **options):
        source = arrival_file(tmp_path, f"{random.random()}.csv", lines)
        return run(spark, "", dst, ["fact_immigration"], paths={"immigration": source}, mode=mode, checks=False, keep_steps=True, **options)["fact_immigration"]

    yield load, f"{dst}/fact_immigration"
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_refresh_reads_only_files_that_meet_the_batch(spark, fact):
    load, path = fact
    built = load(rows(600), "overwrite", versioned=True)
    assert built.counts["written"] == 600 and built.balanced and versions.current_version(spark, path) == 0
    assert {f.name: f.dataType for f in built.written_schema(spark)} == {f.name: f.dataType for f in built.read(spark).schema}
    before = contents(spark, path)
    listed = versions.files_of(spark, path).count()
    # later keys meet no file, known ones few
    built = load(rows(100, 600))
    assert built.change.files == {"listed": listed, "read": 0, "rewritten": 0}
    assert contents(spark, path)[:600] == before and [r[0] for r in contents(spark, path)] == list(range(700))
    built = load([*rows(3, 10, 4), *rows(2, 700, 4)])
    files = built.change.files
    assert files["listed"] > listed and 0 < files["rewritten"] <= files["read"] < files["listed"] / 2
    assert len(built.change.replaced.inputFiles()) > 0 and built.counts["written"] == 5 and built.balanced
    now = contents(spark, path)
    assert [r[0] for r in now] == list(range(702)) and [r[1] for r in now if r[3] == 5] == [10, 11, 12, 700, 701]
    # the same batch again changes nothing but the number of the version
    load([*rows(3, 10, 4), *rows(2, 700, 4)])
    assert contents(spark, path) == now
    assert load([]).counts["written"] == 0 and contents(spark, path) == now
    # an earlier version can be read and brought back, unused files can go
    old = versions.read_files(spark, path, FACT_IMMIGRATION.schema, versions.files_of(spark, path, 0))
    assert old.count() == 600
    assert versions.remove_unused(spark, path) == [] and contents(spark, path) == now
    built = load(rows(5), "overwrite")
    assert built.counts["written"] == 5 and len(contents(spark, path)) == 5
    assert versions.remove_unused(spark, path) == [0, 1, 2, 3] and len(contents(spark, path)) == 5


def test_a_run_that_dies_before_the_swap_leaves_the_table(spark, fact, monkeypatch):
    load, path = fact
    load(rows(50), "overwrite", versioned=True)
    before = contents(spark, path)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "point_to", dies)
        with pytest.raises(RuntimeError, match="lost"):
            load(rows(60, 20, 3))
    assert contents(spark, path) == before
    load(rows(10, 45, 7))
    now = contents(spark, path)
    assert len(now) == 55 and [r for r in now if r[3] == 4] == [] and now[:45] == before[:45]
    # two writers: the second one finds another version
    files = versions.files_of(spark, path)
    new = versions.read_files(spark, path, FACT_IMMIGRATION.schema)
    with pytest.raises(RuntimeError, match="meanwhile"):
        versions.publish(new, path, "uid", ["state_code"], "immigration_id", files.limit(0), since=0)
    assert contents(spark, path) == now


def test_look_up_and_repeats_read_few_files(spark, fact):
    load, path = fact
    load(rows(600), "overwrite", versioned=True)
    schema = FACT_IMMIGRATION.schema
    keys = spark.createDataFrame([(30,), (31,), (31,), (10_000,), (None,)], "uid long")
    found = versions.look_up(spark, path, schema, "uid", keys)
    assert sorted(r.uid for r in found.collect()) == [30, 31]
    assert len(found.inputFiles()) < versions.files_of(spark, path).count() / 2
    # a repeat planted by hand is found in the ranges of its batch, and not in those of another one
    planted = versions.read_files(spark, path, schema).where("uid in (7, 300)").withColumn("mode", F.lit(9))
    versions.publish(planted, path, "uid", ["state_code"], "immigration_id", versions.files_of(spark, path), since=0)
    assert [r.uid for r in versions.repeated_keys(spark, path, schema, ["uid"]).sort("uid").collect()] == [7, 300]
    ranges = versions.key_ranges(planted, "uid")
    near = versions.repeated_keys(spark, path, schema, ["uid"], ranges)
    assert sorted(r.uid for r in near.collect()) == [7, 300]
    assert len(near.inputFiles()) < versions.files_of(spark, path).count()
    other = versions.key_ranges(spark.createDataFrame([(150,)], "uid long"), "uid")
    assert versions.repeated_keys(spark, path, schema, ["uid"], other).where("uid in (7, 300)").count() <= 2


def test_ranges(spark):
    keys = spark.createDataFrame([(i,) for i in [*range(0, 100), *range(900, 1000)]], "k long")
    ranges = versions.key_ranges(keys, "k", 10)
    assert not ranges.missing and len(ranges.bounds) <= 10
    files = spark.createDataFrame([(0, 5, 0), (99, 900, 0), (400, 500, 0), (999, 2000, 0), (1000, 2000, 0), (None, None, 3)], "low long, high long, keyless long")
    hit = [r[0] for r in files.select(ranges.meets(F.col("low"), F.col("high"), F.col("keyless"))).collect()]
    assert hit[0] and hit[1] and hit[3] and not hit[4] and not hit[5]
    none = versions.key_ranges(spark.createDataFrame([(None,)], "k long"), "k")
    assert [r[0] for r in files.select(none.meets(F.col("low"), F.col("high"), F.col("keyless"))).collect()] == [False] * 5 + [True]
    texts = versions.key_ranges(spark.createDataFrame([("b",), ("d",)], "k string"), "k")
    files = spark.createDataFrame([("a", "a", 0), ("a", "c", 0), ("e", "f", 0)], "low string, high string, keyless long")
    assert [r[0] for r in files.select(texts.meets(F.col("low"), F.col("high"), F.col("keyless"))).collect()] == [False, True, False]


def test_tables_without_partitions_or_key(spark, tmp_path):
    from test_mart import CITIES

    dst = str(tmp_path / "mart")
    for more, mode, n in (([], "overwrite", 3), (["Utica;Ohio;30.0;1;1;2;1;1;2.0;OH;White;1"], "refresh", 4), ([], "refresh", 4)):
        path = tmp_path / f"{len(more)}{mode}.csv"
        path.write_text("\n".join([*CITIES, *more]) + "\n")
        built = run(spark, "", dst, ["dim_demography"], paths={"demography": str(path)}, checks=True, mode=mode, versioned=True)
        found = built["dim_demography"].read(spark).select("demog_pop_id").sort("demog_pop_id").collect()
        assert [r[0] for r in found] == list(range(n)) and built["dim_demography"].balanced
    assert mart.current_version(spark, f"{dst}/dim_demography") == 1


def test_file_names_are_put_in_order_once_a_file(spark, fact):
    load, path = fact
    load(rows(200), "overwrite", versioned=True)
    contract = FACT_IMMIGRATION
    listed = versions._listed(spark, path, 0, contract.schema, "uid", contract.id_column)
    groups, *below = listed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert groups.startswith("Aggregate") and "regexp_extract" in groups and not any("regexp_extract" in line for line in below)
    assert sorted(listed.collect()) == sorted(versions.files_of(spark, path).select(*listed.columns).collect())
    assert all(r.file.startswith("batch=0/state_code=") for r in listed.collect())
