"""The stages of the corpus pipeline, and the queries of the subpackage."""

import pytest
from compare import connect, difference
from test_llm_operators import near_plain  # noqa: F401  (same folder)

import corpus_pipeline
from starmart.llm import decontamination, secrets
from starmart.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.selectExpr("*", "1 as score", "2 as `_x`", "text as benchmark")
    extra = extra.unionByName(extra.limit(3)).unionByName(extra.limit(1).selectExpr(
        "cast(null as long) doc_id", "cast(null as string) text", "cast(null as string) lang", "cast(null as string) source", "n_chars", "score", "_x", "benchmark"))
    seen, kept = extra, {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        seen = corpus_pipeline.stage(step(spark, seen, SMALL), name)
        assert seen.columns == extra.columns
        kept[name] = seen
    # one of each group stays
    rows = [(r.doc_id, r.text) for r in kept["quality"].collect() if (r.text or "").strip()]
    groups = {name for _, _, name, _ in near_plain(rows, 5, 80)}
    after = [r.doc_id for r in kept["near_duplicates"].collect() if (r.text or "").strip()]
    assert sorted(after) == sorted(groups)
    # clean documents stay, the others go
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    found = decontamination.digest(decontamination.find_benchmark(kept["near_duplicates"], benchmark))
    clean = {r.doc_id for r in found.where("not contaminated").collect()}
    assert {r.doc_id for r in kept["decontamination"].collect()} == clean
    assert secrets.find_secrets(kept["secrets"]).where("size(secrets) > 0").isEmpty()
    assert kept["secrets"].count() == kept["decontamination"].count()
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SMALL)
    assert last.count() == seen.count() and last.where("n_tokens <> size(ids)").isEmpty()


def test_stages_over_no_rows(spark):
    seen = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        seen = step(spark, seen, SMALL)
        assert seen.isEmpty()
