"""Parquet tables: overwrite, partitioned overwrite, partition refresh, declaration."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

if TYPE_CHECKING:
    from ..contracts import TableContract

#: Rows of a compressed text file.
_PACKED_ROWS = 1_000_000


def spread_for(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of one output partition together without one task per value.

    With adaptive execution a rebalance cuts a hot value into advisory-sized pieces
    at run time. Without it the rows of each value are dealt to as many tasks as
    the session has shuffle partitions, which ``conf_for`` sizes by the data, by a
    hash of the row and its input partition, which a repeated task deals the same way.
    """
    conf = df.sparkSession.conf
    slices = int(conf.get("spark.sql.shuffle.partitions"))
    if conf.get("spark.sql.adaptive.enabled", "true") == "true":
        return df.hint("rebalance", *partition_by)
    row = F.xxhash64(*df.columns, F.spark_partition_id())
    return df.repartition(*[F.col(c) for c in partition_by], F.pmod(row, F.lit(slices)))


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
) -> None:
    """Overwrite a Parquet table, in one directory per value of ``partition_by``."""
    writer = (spread_for(df, partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        # an overwrite replaces the whole table whatever the session says
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; the others stay. Can be repeated safely."""
    (
        spread_for(df, partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_bucketed(
    df: DataFrame, table: str, path: str, key: Sequence[str], buckets: int
) -> None:
    """A catalog table at ``path`` in hash buckets of ``key``, each sorted by it.

    Tables with equal keys and numbers of buckets join without a shuffle. For keys
    with few rows each, such as the arrival number; one task writes one bucket.
    """
    (
        df.repartition(buckets, *[F.col(c) for c in key]).write.mode("overwrite")
        .bucketBy(buckets, *key).sortBy(*key)
        .option("path", path).format("parquet").saveAsTable(table)
    )


def write_csv(df: DataFrame, path: str, sep: str = ",", compressed: bool = False) -> None:
    """CSV files with a header row; ``compressed`` ones are gzip, which is read from front to back, so each holds a bounded number of rows."""
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    if compressed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=_PACKED_ROWS).option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path)


def create_table_sql(contract: TableContract, location: str, name: str | None = None) -> str:
    """``CREATE TABLE`` statement that declares a written table under its contract types.

    Keys are no clauses here: files cannot enforce them, the quality checks test them.
    """
    columns = ",\n  ".join(
        f"`{f.name}` {f.dataType.simpleString()} COMMENT '{f.metadata.get('comment', '')}'"
        for f in contract.schema.fields
    )
    parts = ""
    if contract.partition_by:
        parts = f"\nPARTITIONED BY ({', '.join(contract.partition_by)})"
    return (
        f"CREATE TABLE IF NOT EXISTS {name or contract.name} (\n  {columns}\n)\n"
        f"USING parquet{parts}\nLOCATION '{location}'"
    )
