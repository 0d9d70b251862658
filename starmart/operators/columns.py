"""Projections: select, rename, constants, derived columns, vertical split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import normalise_name
from .profile import sparse_columns


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def normalise_names(df: DataFrame) -> DataFrame:
    """``Number of Veterans`` -> ``number_of_veterans``, ``Foreign-born`` -> ``foreign_born``."""
    names = [normalise_name(c) for c in df.columns]
    clashes = {n for n in names if names.count(n) > 1}
    if clashes:
        raise ValueError(f"columns share a normalised name: {sorted(clashes)}")
    return df.toDF(*names)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def replace_columns(df: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    """Put a new expression in the place of each named column."""
    return df.withColumns(dict(expressions))


def add_calendar(df: DataFrame, date: str, year: str = "year", month: str = "month") -> DataFrame:
    return df.withColumns({year: F.year(date), month: F.month(date)})


def drop_sparse(
    df: DataFrame, max_missing_pct: float, keep: Iterable[str] = ()
) -> DataFrame:
    """Drop columns that miss more than the given share, except those in ``keep``."""
    return df.drop(*sparse_columns(df, max_missing_pct, keep))


def split_columns(
    df: DataFrame, key: Sequence[str], parts: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Split one wide frame into several that share ``key``; each reads only its own columns."""
    return {name: project(df, [*key, *columns]) for name, columns in parts.items()}
