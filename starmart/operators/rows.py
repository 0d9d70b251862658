"""Filters, distinct rows, de-duplication and missing-value handling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"
#: So many rows of one key are no burden to a partition.
_FEW = 100_000


def equal_to(df: DataFrame, column: str, *values) -> DataFrame:
    """Rows whose column equals one of the values; NULL never does."""
    c = F.col(column)
    return df.filter(c == F.lit(values[0]) if len(values) == 1 else c.isin(*values))


def in_range(df: DataFrame, column: str, start: int, stop: int | None = None) -> DataFrame:
    """Half-open range filter: ``start <= column < stop``, or without an end."""
    df = df.filter(F.col(column) >= start)
    return df if stop is None else df.filter(F.col(column) < stop)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def survivor_order(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str | Column] = (),
    prefer_complete: Sequence[str] = (),
) -> list[Column]:
    """Total order of the rows of one key: complete rows, then the caller's order, then the rest.

    It names every column, so two rows that tie are equal and the survivor does
    not depend on how the data is partitioned.
    """
    order: list[Column] = []
    if prefer_complete:
        gaps = [F.col(c).isNull().cast("int") for c in prefer_complete]
        order.append(sum(gaps[1:], gaps[0]).asc())
    order += [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    named = {c for c in order_by if isinstance(c, str)} | set(key)
    order += [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    return order or [F.lit(0).asc()]


def dedupe(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str | Column] = (),
    prefer_complete: Sequence[str] = (),
) -> DataFrame:
    """One row per key, always the same one. NULL keys count as one key.

    Each input partition keeps its best row per key before the shuffle (the plan
    shows a partial ``WindowGroupLimit``), so a key that holds a third of all rows
    sends one row per partition. Exact copies need no ``distinct`` first: they tie.
    """
    key = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*key).orderBy(
        *survivor_order(df, key, order_by, prefer_complete)
    )
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def frequent_keys(df: DataFrame, key: str, n_rows: int) -> list:
    """Keys that hold more of the ``n_rows`` rows than a shuffle partition should; a sketch of one pass finds them."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(_FEW, n_rows // (4 * partitions))
    if n_rows <= least:
        return []
    found = df.agg(F.expr(f"approx_top_k(`{key}`, 1000)").alias("top")).first().top or []
    return [r.item for r in found if r.item is not None and r["count"] > least]


def dedupe_in_ranges(
    df: DataFrame, key: str, frequent: Sequence = (), order_by: Sequence[str | Column] = (), prefer_complete: Sequence[str] = ()
) -> DataFrame:
    """The rows of :func:`dedupe`, dealt to partitions by ranges of the key and sorted by it in each: one shuffle for both.

    Rows of the ``frequent`` keys and of the NULL key are reduced apart, before that shuffle, so that no partition
    has to hold them all. Which keys these are does not change the result. ``df`` is read to find the ranges, so
    give a stored one.
    """
    apart = F.col(key).isNull()
    if frequent:
        apart = apart | F.col(key).isin(*frequent)
    few = dedupe(df.filter(apart), key, order_by, prefer_complete)
    return dedupe(df.filter(~apart).unionByName(few).repartitionByRange(key), key, order_by, prefer_complete)


def dedupe_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows before, removed and after a de-duplication on ``key``, as one row."""
    key = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_removed"),
            F.count(F.lit(1)).alias("rows_after"),
        )
    )


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL in any of the critical columns. NaN is a value."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def missing_counts(columns: Sequence[str]) -> list[Column]:
    """Missing count per critical column, each among the rows the earlier columns let pass."""
    counts = []
    passed = F.lit(True)
    for c in columns:
        counts.append(F.count_if(passed & F.col(c).isNull()).alias(c))
        passed = passed & F.col(c).isNotNull()
    return counts


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, column_name, n_missing) of the sequential rule, in one pass."""
    counted = df.agg(*missing_counts(columns))
    entries = [
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column_name"),
            F.col(c).alias("n_missing"),
        )
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*entries)))


def last_wins(df: DataFrame, key: str, value: str, order_by: Iterable[str]) -> DataFrame:
    """Key/value pairs where a later pair replaces an earlier one."""
    position = F.struct(*order_by)
    return df.groupBy(key).agg(F.max_by(value, position).alias(value))
