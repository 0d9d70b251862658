"""Tables kept as versions: files with their key ranges, and a pointer to the version that readers see.

Below the path of a table lie ``data/batch=<n>/...``, the files that version ``n`` added, ``versions/<n>``, the list of all
files of that version with the smallest and largest key, the rows and the largest id of each, and ``versions/current``, the
number of the version in force. Files are never changed. A version is written beside the others; the pointer is replaced last, by
a rename, so a run that dies before it leaves the table as it was, and what it wrote is overwritten by the next one. (The
rename is atomic on HDFS and local file systems.) One writer at a time; a writer that finds another version than it started from fails.

Files are cut by ranges of partition value and key and sorted by key, with a Bloom filter of the key in each row group: a batch or a
look-up of some keys reads the files whose range meets them. A hot partition value is cut into many ranges.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import path_exists, remove_path

#: Key ranges that a set of keys is summed up in; the most that are brought to the driver.
RANGES = 1024
_FILE = "__file"


@dataclass(frozen=True)
class Ranges:
    """Disjoint ranges that hold all keys of a set, and whether a key is missing."""

    bounds: list[tuple]
    missing: bool

    def meets(self, low: Column, high: Column, keyless: Column) -> Column:
        """Whether a file with these bounds can hold one of the keys."""
        hit = F.lit(False)
        if self.bounds:
            lows, highs = (F.array(*map(F.lit, x)) for x in zip(*self.bounds, strict=True))
            pairs = F.arrays_zip(lows.alias("l"), highs.alias("h"))
            hit = F.coalesce(F.exists(pairs, lambda p: (p["l"] <= high) & (p["h"] >= low)), F.lit(False))
        return hit | (keyless > 0) if self.missing else hit


def key_ranges(keys: DataFrame, column: str, ranges: int = RANGES) -> Ranges:
    """At most ``ranges`` ranges over one column, cut so that each holds about as many rows."""
    spread = keys.select(column).where(F.col(column).isNotNull()).repartitionByRange(ranges, column)
    found = spread.groupBy(F.spark_partition_id()).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
    missing = not keys.where(F.col(column).isNull()).isEmpty()
    return Ranges(sorted((r.low, r.high) for r in found), missing)


def current_version(spark: SparkSession, path: str) -> int | None:
    """The number of the version in force; None for a path that holds no versions."""
    pointer = f"{path}/versions/current"
    return int(spark.read.text(pointer).first()[0]) if path_exists(spark, pointer) else None


def files_of(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(file, low, high, keyless, rows, top_id) of one version, by default the one in force."""
    if number is None:
        number = current_version(spark, path)
    return spark.read.parquet(f"{path}/versions/{number}")


def read_files(spark: SparkSession, path: str, schema: StructType, files: DataFrame | None = None, with_file: bool = False) -> DataFrame:
    """The rows of the listed files. Their names go through the driver, as those of any scan do."""
    names = [r[0] for r in (files_of(spark, path) if files is None else files).select("file").collect()]
    known = StructType([*schema.fields, StructField("batch", IntegerType())])
    if not names:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(_FILE, F.lit(None).cast("string")) if with_file else empty
    rows = spark.read.schema(known).option("basePath", f"{path}/data").parquet(*(f"{path}/data/{n}" for n in names))
    columns = [F.col(f"`{f.name}`") for f in schema.fields]
    return rows.select(*columns, _relative(F.col("_metadata.file_path")).alias(_FILE)) if with_file else rows.select(*columns)


def _relative(path: Column) -> Column:
    """A file below ``data`` by its reported name, in which special characters are escaped."""
    name = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(name, "^.*/(batch=[0-9]+/.*)$", 1)


def _listed(spark: SparkSession, path: str, number: int, schema: StructType, key: str, id_column: str | None) -> DataFrame:
    """The list of the files that a version added, from their key and id columns alone."""
    known = StructType([*schema.fields, StructField("batch", IntegerType())])
    rows = spark.read.schema(known).option("basePath", f"{path}/data").parquet(f"{path}/data/batch={number}")
    top = F.max(id_column).cast("long") if id_column else F.lit(None).cast("long")
    listed = rows.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.col(key).isNull()).alias("keyless"), F.count("*").alias("rows"),
        top.alias("top_id"),
    )
    # names are put in order once a file, not once a row
    return listed.withColumn(_FILE, _relative(F.col(_FILE))).withColumnRenamed(_FILE, "file")


def publish(
    rows: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), id_column: str | None = None,
    kept: DataFrame | None = None, since: int | None = None,
) -> int:
    """Write ``rows`` as new files and make them, with the ``kept`` ones of version ``since``, the version in force; its number."""
    spark = rows.sparkSession
    number = 0 if since is None else since + 1
    clustered = rows.repartitionByRange(*partition_by, key).sortWithinPartitions(*partition_by, key)
    writer = clustered.write.mode("overwrite").option("partitionOverwriteMode", "static").option(f"parquet.bloom.filter.enabled#{key}", "true")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/data/batch={number}")
    files = _listed(spark, path, number, rows.schema, key, id_column)
    if kept is not None:
        files = kept.unionByName(files)
    files.write.mode("overwrite").parquet(f"{path}/versions/{number}")
    if current_version(spark, path) != since:
        raise RuntimeError(f"{path} has got another version meanwhile")
    point_to(spark, path, number)
    return number


def point_to(spark: SparkSession, path: str, number: int) -> None:
    """Put a version in force by one rename; an earlier one can be brought back the same way."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{path}/versions/current")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = system.makeQualified(target)
    draft = hadoop.Path(target.getParent(), f".current-{uuid.uuid4().hex}")
    out = system.create(draft)
    out.write(bytearray(str(number).encode()))
    out.close()
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, how)


def look_up(spark: SparkSession, path: str, schema: StructType, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among ``keys`` (a frame with that column), from the files whose range meets one."""
    files = files_of(spark, path)
    near = files.where(key_ranges(keys, key).meets(F.col("low"), F.col("high"), F.col("keyless")))
    return read_files(spark, path, schema, near).join(keys.select(key).distinct(), key, "left_semi").select(*schema.names)


def repeated_keys(spark: SparkSession, path: str, schema: StructType, key: Sequence[str], ranges: Ranges | None = None) -> DataFrame:
    """Keys with more than one row, looked for only in files that meet ``ranges``.

    When the keys outside were unique before a batch and the batch lies in ``ranges``, they still are: a repeat of one of its
    keys is in a file whose range holds that key.
    """
    files = files_of(spark, path)
    if ranges is not None:
        files = files.where(ranges.meets(F.col("low"), F.col("high"), F.col("keyless")))
    rows = read_files(spark, path, schema, files)
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def remove_unused(spark: SparkSession, path: str) -> list[int]:
    """Delete the batches of which the version in force lists no file, and the lists of earlier versions; no reader may be using them."""
    now = current_version(spark, path)
    used = {r[0] for r in files_of(spark, path, now).select(F.regexp_extract("file", "^batch=([0-9]+)/", 1).cast("int")).distinct().collect()}
    gone = [n for n in range(now) if n not in used and path_exists(spark, f"{path}/data/batch={n}")]
    for n in gone:
        remove_path(spark, f"{path}/data/batch={n}")
    for n in range(now):
        remove_path(spark, f"{path}/versions/{n}")
    return gone
