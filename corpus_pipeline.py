"""From raw documents to token ids: quality, near duplicates, benchmark passages, secrets, byte pairs.

Each stage reads what its predecessor kept and hands on the columns of ``documents`` (and any others), all but the last.
Repeated rows, null keys and null texts are allowed everywhere; each operator's docstring says what becomes of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import bpe, decontamination, neardup, quality, secrets
from starmart.llm.common import remainder, table
from starmart.llm.queries import vocabulary_path
from starmart.sinks.stage import stage

LEAST_QUALITY = 0.3
#: Words that a task of the last stage remembers; an executor still holds what the stages before it took.
WORDS = 50_000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``LEAST_QUALITY``; learned from labelled ones outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    scored = quality.score(docs, quality.fit(docs, labels), result="_quality")
    return scored.where(F.col("_quality") >= LEAST_QUALITY).select(*(F.col(f"`{c}`") for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, and every document without words."""
    words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    found = neardup.near_duplicates(docs.where(words))
    # several rows of a group can have its smallest id
    first = found.where("kept").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    first = stage(first.select("first.doc_id", F.col("first.text_key").alias("_key")), "kept-documents")
    rows = docs.where(words).withColumn("_key", neardup.text_key(F.col("text")))
    same = rows["doc_id"].eqNullSafe(first["doc_id"]) & (rows["_key"] == first["_key"])
    kept = rows.join(first, same, "left_semi").dropDuplicates(["doc_id", "_key"]).drop("_key")
    return kept.unionByName(docs.where(~words))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontamination.find_benchmark(docs, table(spark, sf_dir, "benchmark"), result="_benchmark")
    return found.where(F.size("_benchmark.word_spans") == 0).drop("_benchmark")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; ``n_chars`` follows the text."""
    found = secrets.find_secrets(docs, result="_secrets")
    changed = F.size("_secrets") > 0
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col("_secrets")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return clean.select(*(F.col(f"`{c}`") for c in docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document."""
    found = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path(), decoded=False, memo=WORDS)
    ids = F.col("bpe.ids")
    return found.select("doc_id", "lang", "source", F.size(ids).cast("long").alias("n_tokens"), ids.alias("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", token_ids),
]

#: Trees, MinHash and byte pairs are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage's is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
