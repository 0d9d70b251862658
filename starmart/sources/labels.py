"""Label files: lines ``code = 'label'`` in sections of a text file."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import strip_blank, strip_quotes, strip_tabs
from ..operators.rows import in_range, last_wins
from ..sinks.stage import stage


def read_lines(
    spark: SparkSession, path: str | Sequence[str], folder: str | None = None
) -> DataFrame:
    """(file, pos, line) for every line of every file, ``pos`` counting from 0 in each file.

    Files are split like any other text source. A line's number is the number of
    lines in the earlier blocks of its file plus its number in its own block. The
    blocks are stored first: a second scan might be split in another way when the
    cluster grows or shrinks.
    """
    text = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )
    blocks = stage(text, "lines", folder)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy("file", "block")
        .agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .select("file", "block", (F.col("start") - F.col("first_seq")).alias("shift"))
    )
    return (
        blocks.join(starts, ["file", "block"])
        .select("file", (F.col("seq") + F.col("shift")).alias("pos"), "line")
    )


@dataclass(frozen=True)
class LabelSection:
    """Where a code table's lines are and how its two sides are cleaned."""

    table: str
    label: str
    start: int
    stop: int | None
    clean_code: Callable[[Column], Column]
    clean_label: Callable[[Column], Column]


# Line ranges (half-open, from 0) and strip rules of the label file.
LABEL_SECTIONS = {
    "country_code": LabelSection(
        "country_code", "country", 10, 298,
        strip_blank, lambda c: strip_quotes(strip_blank(c)),
    ),
    "city_code": LabelSection(
        "city_code", "city", 303, 962,
        lambda c: strip_quotes(strip_blank(strip_tabs(c))),
        lambda c: strip_quotes(strip_blank(strip_tabs(c))),
    ),
    "state_code": LabelSection(
        "state_code", "state", 982, 1036,
        lambda c: strip_quotes(strip_tabs(c)), lambda c: strip_quotes(strip_blank(c)),
    ),
}


def parse_labels(lines: DataFrame, section: LabelSection) -> DataFrame:
    """(code, label) of one section; a later line replaces an earlier one of the same code.

    The text after a second ``=`` is dropped. Lines without ``=`` are left to
    :func:`label_rejects`.
    """
    parts = F.split("line", "=")
    pairs = (
        in_range(lines, "pos", section.start, section.stop)
        .select(
            "file", "pos",
            section.clean_code(F.get(parts, F.lit(0))).alias("code"),
            section.clean_label(F.get(parts, F.lit(1))).alias(section.label),
        )
        .filter(F.col(section.label).isNotNull())
    )
    return last_wins(pairs, "code", section.label, ["file", "pos"])


def rejects(lines: DataFrame, start: int, stop: int | None) -> DataFrame:
    return in_range(lines, "pos", start, stop).filter(~F.contains("line", F.lit("=")))


def label_rejects(lines: DataFrame, section: LabelSection) -> DataFrame:
    """Lines of a section that hold no pair."""
    return rejects(lines, section.start, section.stop)
