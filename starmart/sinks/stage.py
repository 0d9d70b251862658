"""Written steps: a frame stored once in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import new_path, remove_path


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the stored table.

    ``folder`` gathers the steps of one run, to be removed together.

    Cuts the lineage: later jobs read the file, with column pruning and
    pushdown, and a lost executor repeats none of the work before it.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else new_path(spark, name)
    # the steps of a run lie there beside each other, so they are packed more tightly
    (df.write.option("compression", "zstd") if folder else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_steps(spark: SparkSession, folder: str | None, *names: str) -> None:
    """Remove steps of a run that nothing will read again; steps without a folder of their run stay."""
    for name in names if folder else ():
        remove_path(spark, f"{folder}/{name}")
