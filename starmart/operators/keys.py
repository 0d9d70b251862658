"""Surrogate ids and the unique-key assertion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.stage import stage

_TAG = "__tag"
_PART = "__part"
_START = "__start"
_SPLIT = "__split"
# monotonically_increasing_id(): partition number above bit 33, row number below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def sparse_id(df: DataFrame, name: str) -> DataFrame:
    """Unique 64-bit id with gaps; changes when the partitioning changes."""
    return df.withColumn(name, F.monotonically_increasing_id())


def dense_id(df: DataFrame, name: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Ids 0..n-1 in the given order, the same however the input is partitioned.

    A range-partitioned sort is written once with each row's (partition, row)
    number; an id is the number of rows in earlier partitions plus the row number.
    Only the per-partition counts meet in one place: as many rows as the sort has
    partitions. All columns break ties, so rows with one hot ``order_by`` value
    still spread, and equal rows spread by the input partition they come from.
    """
    return number_staged(stage(tag_rows(df, order_by), f"ordered-{name}"), name)


def tag_rows(
    df: DataFrame, order_by: Sequence[str | Column] | None, order_is_unique: bool = False
) -> DataFrame:
    """Add each row's (partition, row) number, after a total sort when an order is given.

    The other columns break ties unless the order is known to have none.
    """
    if order_by is not None:
        named = {c for c in order_by if isinstance(c, str)}
        order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
        if order_is_unique:
            df = df.sort(*order)
        else:
            order += [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
            # the same in every attempt of a task, unlike a row number
            df = df.withColumn(_SPLIT, F.spark_partition_id()).sort(*order, _SPLIT).drop(_SPLIT)
    return df.withColumn(_TAG, F.monotonically_increasing_id())


def tagged_counts(tagged: DataFrame, *counts: Column) -> DataFrame:
    """One row per sort partition of tagged rows, with the given aggregates."""
    return tagged.groupBy(F.shiftright(_TAG, _ROW_BITS).alias(_PART)).agg(*counts)


def number_staged(staged: DataFrame, name: str, dense: bool = True, counts: DataFrame | None = None) -> DataFrame:
    """Turn the tags of a staged frame into ids: dense ones, or the tags themselves.

    ``counts`` are the rows (``__n``) by sort partition (:func:`tagged_counts`), when they are known; otherwise
    each use of the result reads the tags for them.
    """
    if not dense:
        return staged.withColumnRenamed(_TAG, name)
    part = F.shiftright(_TAG, _ROW_BITS)
    # one row per sort partition, so the window below orders that many rows and no more
    if counts is None:
        counts = tagged_counts(staged, F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(_PART), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_START)
    )
    row = F.col(_TAG).bitwiseAND(F.lit(_ROW_MASK))
    return (
        staged.withColumn(_PART, part)
        # bounded by the number of sort partitions
        .join(F.broadcast(starts), _PART)
        .withColumn(name, F.col(_START) + row)
        .drop(_TAG, _PART, _START)
    )


def require_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``df`` itself when the key is unique and never NULL; raises otherwise.

    Runs one aggregation over the key columns.
    """
    key = [key] if isinstance(key, str) else list(key)
    any_null = F.greatest(*[F.col(c).isNull() for c in key]) if len(key) > 1 else F.col(key[0]).isNull()
    found = (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(F.col("n") > 1).alias("repeated"),
            F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).alias("empty"),
        )
        .first()
    )
    if found.repeated or found.empty:
        raise ValueError(
            f"key {key} is not unique: {found.repeated} repeated keys, {found.empty} rows without key"
        )
    return df
