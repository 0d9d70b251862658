"""Tables that share one key, kept in hash buckets of it: they join and group by the key without a shuffle.

Below the path of a table lie ``data``, Parquet files in ``buckets`` buckets of the key, each sorted by it, and ``parts/<name>``, one row for
each part of the table: its name, the key, the number of buckets, the rows and the largest id. The first write makes one part, a
refresh adds one: no stored file is changed or shuffled. A row carries its part's name, and of the rows of a key the one of the
latest part counts. Since the rows of a key lie in one bucket, readers find it without a shuffle. Files of a run that died before its
part was entered are not read. One writer at a time.

Buckets are even when the key is unique within a part. A part whose rows have no key, or of which some bucket holds far more rows than
the others, is refused before it is written.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import path_exists, remove_path

PART = "__part"
#: A bucket may hold this many times the mean, and so many rows in any case.
UNEVEN, FEW = 4, 100_000


class UnevenBuckets(ValueError):
    """Some key is missing, or holds too many rows for one bucket."""


@dataclass(frozen=True)
class Layout:
    """The parts of a table, oldest first, and how its files are dealt."""

    key: str
    buckets: int
    parts: tuple[str, ...]
    rows: int
    top_id: int | None


def layout_of(spark: SparkSession, path: str) -> Layout | None:
    """The layout found at ``path``; None for a path that holds no aligned table."""
    if not path_exists(spark, f"{path}/parts"):
        return None
    found = sorted(spark.read.parquet(f"{path}/parts/*").collect(), key=lambda r: r.part)  # one row a refresh
    tops = [r.top_id for r in found if r.top_id is not None]
    return Layout(found[0].key, found[0].buckets, tuple(r.part for r in found), sum(r.rows for r in found), max(tops, default=None))


def _name(path: str) -> str:
    """The name under which a session knows the files of ``path``."""
    return f"aligned_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _declared(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> str:
    name = _name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, StructField(PART, StringType())])
    place = f"{path}/data".replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return name


def _check_even(df: DataFrame, key: str, buckets: int) -> int:
    """The number of rows, when each has a key and no bucket stands out."""
    bucket = F.when(F.col(key).isNotNull(), F.pmod(F.hash(key), F.lit(buckets)))
    counted = {r.bucket: r["n"] for r in df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if counted.get(None):
        raise UnevenBuckets(f"{counted[None]} rows lack the key {key}")
    n_rows, most = sum(counted.values()), max(counted.values(), default=0)
    if most > max(FEW, UNEVEN * n_rows / buckets):
        raise UnevenBuckets(f"one of {buckets} buckets of {key} would hold {most} of {n_rows} rows")
    return n_rows


def write_aligned(df: DataFrame, path: str, key: str, buckets: int, id_column: str | None = None) -> int:
    """Write ``df`` as the only part of the table at ``path``, replacing what is there; the number of rows. ``df`` is read more than once."""
    spark = df.sparkSession
    _check_even(df, key, buckets)
    remove_path(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    return _add(df, path, key, buckets, 0, id_column)


def append_aligned(df: DataFrame, path: str, id_column: str | None = None) -> int:
    """Add a part, whose rows stand for the stored ones of their keys; the number of rows. ``df`` is read more than once."""
    layout = layout_of(df.sparkSession, path)
    _check_even(df, layout.key, layout.buckets)
    return _add(df, path, layout.key, layout.buckets, len(layout.parts), id_column)


def _add(df: DataFrame, path: str, key: str, buckets: int, number: int, id_column: str | None) -> int:
    spark = df.sparkSession
    part = f"{number:08d}-{uuid.uuid4().hex}"
    table = _declared(spark, path, df.schema, key, buckets)
    df.withColumn(PART, F.lit(part)).repartition(buckets, key).write.insertInto(table)
    top = F.max(id_column).cast("long") if id_column else F.lit(None).cast("long")
    entry = spark.table(table).where(F.col(PART) == part).agg(F.count(F.lit(1)).alias("rows"), top.alias("top_id")).select(
        F.lit(part).alias("part"), F.lit(key).alias("key"), F.lit(buckets).alias("buckets"), "rows", "top_id"
    )
    entry.write.parquet(f"{path}/parts/{part}")
    return spark.read.parquet(f"{path}/parts/{part}").first().rows


def read_aligned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows in force, dealt by the key: joins and groups by it need no shuffle."""
    layout = layout_of(spark, path)
    table = _declared(spark, path, schema, layout.key, layout.buckets)
    spark.catalog.refreshTable(table)
    rows = spark.table(table).where(F.col(PART).isin(*layout.parts))
    if len(layout.parts) > 1:
        latest = Window.partitionBy(layout.key).orderBy(F.desc(PART))
        rows = rows.withColumn("__rn", F.row_number().over(latest)).where("__rn = 1")
    return rows.select(*(F.col(f"`{f.name}`") for f in schema.fields))
