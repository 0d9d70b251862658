"""Data-quality checks. Each gives rows; none changes or drops data.

Checks that end in a report have the columns (table_name, check_name, column_name, value,
status), where ``value`` counts violations and ``status`` is ``ok`` or ``failed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FractionalType, StructType

from ..contracts import ForeignKey, TableContract
from ..functions import cast_failed
from ..operators.joins import orphans
from ..operators.quantiles import exact_quantiles


def report_row(table: str, check: str, column: str, value: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        value.cast("bigint").alias("value"),
        F.when(value == 0, "ok").otherwise("failed").alias("status"),
    )


def _rows(counted: DataFrame, rows: list[Column]) -> DataFrame:
    return counted.select(F.inline(F.array(*rows)))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_primary_key(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Repeated keys and rows with a NULL key part, from one grouping by the key."""
    empty = F.lit(False)
    for c in key:
        empty = empty | F.col(c).isNull()
    counted = (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.count_if((F.col("__n") > 1) & ~empty).alias("repeated"),
            F.coalesce(F.sum(F.when(empty, F.col("__n"))), F.lit(0)).alias("empty"),
        )
    )
    name = ",".join(key)
    return _rows(counted, [
        report_row(table, "primary_key_unique", name, F.col("repeated")),
        report_row(table, "primary_key_not_null", name, F.col("empty")),
    ])


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values of a unique column that occur more than once; NULLs are no values."""
    counted = repeated_keys(df.filter(F.col(column).isNotNull()), [column]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return _rows(counted, [report_row(table, "unique", column, F.col("n"))])


def check_foreign_key(
    child: DataFrame, parent: DataFrame, table: str, foreign_key: ForeignKey
) -> DataFrame:
    """Rows whose key the parent table lacks."""
    lost = orphans(
        child, parent, foreign_key.columns, foreign_key.parent_columns, foreign_key.normalised
    )
    counted = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    return _rows(counted, [report_row(table, "foreign_key", foreign_key.label, F.col("n"))])


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Missing values per critical column, each counted on its own."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    return _rows(counted, [
        report_row(table, "not_null", c, F.col(f"n{i}")) for i, c in enumerate(columns)
    ])


def failed_casts(df: DataFrame, schema: StructType) -> DataFrame:
    """(column_name, data_type, n_values, n_failed): values their target type cannot hold."""
    fields = [f for f in schema.fields if f.name in df.columns]
    aggregates = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.count_if(cast_failed(c, df.schema[f.name].dataType, f.dataType)).alias(f"bad{i}"),
        ]
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("n_values"),
            F.col(f"bad{i}").alias("n_failed"),
        )
        for i, f in enumerate(fields)
    ]
    return _rows(df.agg(*aggregates), entries)


def check_types(
    df: DataFrame, contract: TableContract, written: StructType | None = None
) -> DataFrame:
    """Columns of a table whose type differs from the contract (1) or not (0).

    ``written`` is the schema found in the files, when ``df`` was read under another.
    """
    drift = schema_drift(written or df.schema, contract.schema, df)
    return drift.select(
        F.lit(contract.name).alias("table_name"),
        F.lit("data_type").alias("check_name"),
        "column_name",
        (F.col("status") != "ok").cast("bigint").alias("value"),
        F.when(F.col("status") == "ok", "ok").otherwise("failed").alias("status"),
    )


def schema_drift(found: StructType, expected: StructType, df: DataFrame) -> DataFrame:
    """(column_name, expected_type, found_type, status) for every column of either schema.

    ``status`` is ``ok``, ``missing``, ``extra`` or ``retyped``. ``df`` lends its session.
    """
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name in [*want, *(n for n in have if n not in want)]:
        if name not in have:
            status = "missing"
        elif name not in want:
            status = "extra"
        else:
            status = "ok" if have[name] == want[name] else "retyped"
        rows.append((name, want.get(name), have.get(name), status))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, found_type string, status string"
    )


def row_balance(df: DataFrame, key: Sequence[str], critical: Sequence[str]) -> DataFrame:
    """Rows in, removed as copies, removed for missing values, and out, when ``df`` is
    cleaned in this order: one row per key, preferring complete rows, then no NULL in ``critical``.

    A key passes when any of its rows is complete, so flags per key are enough and no
    row is moved.
    """
    complete = F.lit(True)
    for c in critical:
        complete = complete & F.col(c).isNotNull()
    counted = (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("__n"), F.max(complete).alias("__complete"))
        .agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_in"),
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("rows_duplicate"),
            F.count_if(~F.col("__complete")).alias("rows_missing"),
            F.count_if(F.col("__complete")).alias("rows_out"),
        )
    )
    left = F.col("rows_in") - F.col("rows_duplicate") - F.col("rows_missing")
    return counted.withColumn("balanced", left == F.col("rows_out"))


def outlier_bounds(df: DataFrame, column: str, reach: float = 1.5) -> tuple[float, float] | None:
    """Lower and upper limit: ``reach`` times the quartile distance beyond the quartiles."""
    q1, q3 = exact_quantiles(df, column, [0.25, 0.75])
    if q1 is None:
        return None
    return q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)


def outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Rows whose value lies outside the limits; the limits are literals, so scans can skip."""
    bounds = outlier_bounds(df, column, reach)
    if bounds is None:
        return df.filter(F.lit(False))
    out = (F.col(column) < bounds[0]) | (F.col(column) > bounds[1])
    if isinstance(df.schema[column].dataType, FractionalType):
        out = out & ~F.isnan(F.col(column).cast("double"))  # NaN sorts above all numbers
    return df.filter(out)
