"""Column profiles and duplicate counts, one pass each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def _missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a floating column."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row per column: rows, missing count and percentage, distinct values, min, max, type.

    Everything but an exact distinct count is a single aggregate that keeps a few
    bytes per column and task. ``exact_distinct`` shuffles every distinct value
    of every column; the default is a HyperLogLog estimate.
    """
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        aggregates += [
            F.count_if(_missing(df, name)).alias(f"missing_{i}"),
            F.min(c).cast("string").alias(f"min_{i}"),
            F.max(c).cast("string").alias(f"max_{i}"),
        ]
        if not exact_distinct:
            aggregates.append(F.approx_count_distinct(c).alias(f"distinct_{i}"))
    totals = df.agg(*aggregates)
    at = F.col("position")

    def of_each(values: list[Column]) -> Column:
        return F.get(F.array(*values), at)

    n_missing = of_each([F.col(f"missing_{i}") for i in range(len(df.columns))])
    # one row per column; what a caller does not select of it is not computed
    rows = totals.select(F.explode(F.array(*map(F.lit, range(len(df.columns))))).alias("position"), "*").select(
        "position",
        of_each([F.lit(name) for name in df.columns]).alias("column_name"),
        of_each([F.lit(dtype) for _, dtype in df.dtypes]).alias("data_type"),
        F.col("n").alias("n_rows"),
        n_missing.alias("n_missing"),
        F.when(F.col("n") > 0, n_missing * 100.0 / F.col("n")).alias("pct_missing"),
        F.lit(None).cast("bigint").alias("n_distinct") if exact_distinct
        else of_each([F.col(f"distinct_{i}") for i in range(len(df.columns))]).alias("n_distinct"),
        of_each([F.col(f"min_{i}") for i in range(len(df.columns))]).alias("min_value"),
        of_each([F.col(f"max_{i}") for i in range(len(df.columns))]).alias("max_value"),
    )
    if not exact_distinct:
        return rows
    return (
        rows.drop("n_distinct")
        .join(F.broadcast(_distinct_counts(df)), "position", "left")
        .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)).cast("bigint"))
        .select("position", "column_name", "data_type", "n_rows", "n_missing", "pct_missing",
                "n_distinct", "min_value", "max_value")
    )


def _distinct_counts(df: DataFrame) -> DataFrame:
    """(position, n_distinct) with one row per column, from distinct (column, value) pairs.

    The pairs are combined before the shuffle, so frequent values cost nothing.
    """
    cells = [
        F.struct(F.lit(i).alias("position"), F.col(f"`{c}`").cast("string").alias("value"))
        for i, c in enumerate(df.columns)
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("position").agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def sparse_columns(df: DataFrame, max_missing_pct: float, keep: Iterable[str] = ()) -> list[str]:
    """Names of columns that miss more than ``max_missing_pct`` percent of their values."""
    kept = set(keep)
    shares = df.agg(*[
        F.avg(_missing(df, c).cast("int") * 100.0).alias(f"c{i}") for i, c in enumerate(df.columns)
    ]).first()
    return [
        c for c, share in zip(df.columns, shares)
        if c not in kept and share is not None and share > max_missing_pct
    ]


def duplicate_rows(df: DataFrame, name: str = "n_duplicates") -> DataFrame:
    """Rows beyond the first of each group of equal rows; NULLs compare equal."""
    return (
        df.groupBy(*[F.col(f"`{c}`") for c in df.columns])
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias(name))
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))
