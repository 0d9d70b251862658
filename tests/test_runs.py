"""Sources that the run queries derive from the given tables."""

from spark_checks.runs import label_lines


def test_label_lines_group_only_the_orders_that_make_a_line(spark, tmp_path):
    rows = [(i % 1500, i) for i in range(6000)] + [(None, 7), (11, None), (10**12, 3)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = label_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    # the semi join stands below the aggregate
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    found = dict(map(tuple, lines.collect()))
    newest = {k: max(c for p, c in rows if p == k and c is not None) for k in range(1036)}
    assert len(found) == 1036 and found[1035] == f"\t'S{newest[1035] % 400}'='state 1035'"
    assert found[12] == f"   {newest[12] % 400} =  'country 12'" and found[17] == "no pair"
    assert found[310] == f"\t'C{newest[310] % 400}'\t=\t'town 310, XX  '"


def test_label_file_is_one_file_and_its_lines_alone_meet_in_one_task(spark, tmp_path, monkeypatch):
    from spark_checks import runs

    seen = []
    spark.createDataFrame([(i, i) for i in range(2000)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(runs, "run", lambda spark, base, *a, **b: seen.append(base) or {})
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **b: None)
    runs.mart_labels_rejected(spark, str(tmp_path))
    written = spark.read.text(f"{seen[0]}/{runs.SOURCE_FILES['labels']}")
    assert len(written.inputFiles()) == 1 and written.count() == 1036


def test_long_numbers_are_read_with_every_digit(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from starmart.functions import number_to_long

    texts = ["7", "-7.9", "+7.0", "5.", ".5", "9999999999999.9", "99999999999999999.9", "9" * 15 + ".9", "0.99999999999999999", " 5 ", "5\t",
             "1e3", "9223372036854775807", "-9223372036854775808.0"]
    odd = ["9223372036854775808", "x", "", ".", "-", "1.2.3", "5\x01", "\x015", "1 2", "0x10", "1d", "NaN", "Infinity", "2016-04-01", "１"]
    rows = spark.createDataFrame([(t,) for t in [*texts, *odd]], "t string")
    found = dict(map(tuple, rows.select("t", number_to_long(F.col("t"))).collect()))
    assert found == {t: int(Decimal(t.strip())) for t in texts} | dict.fromkeys(odd)
    # text of a few digits is read before a pattern is tried
    plan = rows.select(number_to_long(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "as double" in plan


def test_bad_keys_are_parsed_once(spark, tmp_path, monkeypatch):
    from starmart.plans import run
    from starmart.plans.recipes import FACT
    from starmart.sinks import stage as plain_stage

    stored = {}

    def stage(df, name, folder=None):
        stored[name] = plain_stage(df, name, folder)
        return stored[name]

    monkeypatch.setattr("starmart.plans.mart.stage", stage)
    rows = [(k, "2016.0", "4.0", "A", "X", "20573.0", "20575.0", "1.0", "2.0") for k in ("1.0", "2.5", "x", "2", None, " ")]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FACT.columns)).write.parquet(f"{tmp_path}/in")
    built = run(spark, "", f"{tmp_path}/mart", tables=["fact_immigration"], paths={"immigration": f"{tmp_path}/in"},
                formats={"immigration": "parquet"}, checks=False, keep_steps=True)["fact_immigration"]
    assert built.counts["bad_keys"] == 2 and built.counts["written"] == 2 and built.balanced
    kept = stored["bad-keys-fact_immigration"].collect()
    assert sorted(r.uid for r in kept) == ["2.5", "x"] == sorted(r.uid for r in spark.read.parquet(built.bad_keys).collect())


def test_a_source_of_one_table_is_parsed_once(spark, tmp_path, monkeypatch):
    from starmart.plans import run
    from starmart.plans.recipes import FACT
    from starmart.sinks import stage as plain_stage

    stored = []

    def stage(df, name, folder=None):
        stored.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return plain_stage(df, name, folder)

    monkeypatch.setattr("starmart.plans.mart.stage", stage)
    monkeypatch.setattr("starmart.sources.files.stage", stage)
    rows = [(k, "2016.0", "4.0", "A", "X", d, "20575.0", "1.0", "2.0")
            for k, d in (("3.0", "20573.0"), ("1.0", "20573.0"), ("2.5", "20573.0"), ("x", "20573.0"), ("2", "20573.0"), ("2", None), ("0", None), (None, "20573.0"), (" ", "20573.0"))]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FACT.columns)).repartition(3).write.option("header", True).csv(f"{tmp_path}/in")
    built = run(spark, "", f"{tmp_path}/mart", tables=["fact_immigration"], paths={"immigration": f"{tmp_path}/in"}, checks=False)["fact_immigration"]
    assert built.balanced and built.counts["bad_keys"] == 2 and built.counts["missing"] == 2
    assert [name for name, plan in stored if "csv" in plan.lower()] == ["typed-fact_immigration"]
    # ids count the complete rows alone, in the order of the key
    found = built.read(spark).sort("uid").select("uid", "immigration_id").collect()
    assert [tuple(r) for r in found] == [(1, 0), (2, 1), (3, 2)]
    cleaned = dict(stored)["cleaned-fact_immigration"]
    assert "rangepartitioning(uid" in cleaned and "upper(" not in cleaned
