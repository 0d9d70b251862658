"""Profiles that can be kept: rows, missing values, bounds and a KLL sketch of each column and group, updated group by group.

A refresh makes the rows of the groups it touched anew; null shares and bounds of the whole table are then exact sums over the
groups, and the union of their sketches gives the brackets from which :func:`exact_quantiles` starts, so the pass that looks for
brackets is saved. The sketch is never the answer: the counting pass proves or moves each bracket. Rows and missing values
are exact. NaN is a missing value, as in the quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Items a sketch keeps at its top level, and the rank error that goes with it (about 1.33 / k for one quantile).
ITEMS = 1000
RANK_ERROR = 0.004


@dataclass(frozen=True)
class Bracketing:
    """What is known of a column before its values are counted: exact numbers, and a value near each asked rank."""

    n: int
    low: float | None
    high: float | None
    margin: float
    bounds: dict[float, float]


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def column_profiles(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, column_name, n_rows, n_missing, low, high, sketch) of number columns; partial sketches are made before the shuffle."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(_number(c).isNull()).alias("n_missing"),
            F.min(_number(c)).alias("low"), F.max(_number(c)).alias("high"), F.kll_sketch_agg_double(_number(c), F.lit(ITEMS)).alias("sketch"),
        ).alias(f"__c{i}")
        for i, c in enumerate(columns)
    ]
    made = df.groupBy(*by).agg(*parts)
    return made.select(*by, F.inline(F.array(*(F.col(f"__c{i}") for i in range(len(columns))))))


def refreshed_profiles(stored: DataFrame, rows: DataFrame, columns: Sequence[str], by: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
    """``stored`` profiles with those of the groups found in ``rows`` (all rows of these groups) made anew.

    ``touched`` lists groups (columns ``by``) that a refresh changed, those left without rows too; by default those of ``rows``.
    """
    new = column_profiles(rows, columns, by)
    gone = (rows if touched is None else touched).select(*(F.col(c).alias(f"__{c}") for c in by)).distinct()
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return stored.join(gone, on, "left_anti").unionByName(new)


def null_shares(profiles: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_missing, pct_missing) of the whole table, from the profiles of its groups."""
    whole = profiles.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"))
    share = F.when(F.col("n_rows") > 0, F.col("n_missing") * 100.0 / F.col("n_rows"))
    return whole.withColumn("pct_missing", share)


def bracketing(profiles: DataFrame, column: str, probabilities: Sequence[float]) -> Bracketing:
    """What the stored profiles say of ``column``; reads one row a group and no other data."""
    margin = 2 * RANK_ERROR
    sides = sorted({p + side for p in probabilities for side in (-margin, margin) if 0 < p + side < 1}) or [0.5]
    whole = profiles.where(F.col("column_name") == column).agg(
        F.coalesce(F.sum(F.col("n_rows") - F.col("n_missing")), F.lit(0)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        # a sketch of no values has no quantiles
        F.kll_merge_agg_double(F.when(F.col("n_rows") > F.col("n_missing"), F.col("sketch")), F.lit(ITEMS)).alias("sketch"),
    )
    points = F.kll_sketch_get_quantile_double("sketch", F.lit(sides))
    found = whole.select("n", "low", "high", F.when(F.col("n") > 0, points).alias("bounds")).first()
    return Bracketing(found.n, found.low, found.high, margin, dict(zip(sides, found.bounds or ())))
