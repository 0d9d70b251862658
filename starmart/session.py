"""Session settings and the shared working folder.

Everything that has to be written between two steps (staged tables, landed
sources) goes below the folder named by ``spark.checkpoint.dir``, because every
executor can reach it and a lost executor loses nothing there.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

_MIB = 1024 * 1024

#: Compressed text is about so many times as long when it is read.
_UNPACKED = 3

# A shuffle of m map and r reduce tasks moves m * r blocks. From so many partitions on they grow
# before their number does, up to the largest one.
_MANY_PARTITIONS, _LARGEST_PARTITION = 30_000, 512 * _MIB


def conf_for(input_bytes: int, partition_bytes: int = 128 * _MIB) -> dict[str, str]:
    """Settings for a job that reads and shuffles about ``input_bytes``.

    Adaptive execution merges small shuffle partitions but never splits
    ordinary ones, so the starting number follows the data; the advisory size is
    what skewed and rebalanced partitions are cut to.
    """
    piece = max(partition_bytes, min(_LARGEST_PARTITION, input_bytes // _MANY_PARTITIONS))
    partitions = max(8, -(-input_bytes // piece))
    split = max(128 * _MIB, piece)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(piece),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
    }


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files at a path, which may be a pattern; 0 when there are none. Compressed text counts as about what it unpacks to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    system = target.getFileSystem(conf)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    size = 0
    for found in system.globStatus(target) or []:
        files = system.listFiles(found.getPath(), True)
        while files.hasNext():
            file = files.next()
            size += file.getLen() * (1 if codecs.getCodec(file.getPath()) is None else _UNPACKED)
    return size


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    given = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, given)


@contextmanager
def enough_partitions(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """At least as many shuffle partitions as ``conf_for`` gives; a higher setting of the session stays."""
    name = "spark.sql.shuffle.partitions"
    with _set(spark, name, str(max(int(spark.conf.get(name)), int(conf_for(input_bytes)[name])))):
        yield


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files go when the query that wrote them ends; otherwise they stay until the driver happens to collect its garbage."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def working_dir(spark: SparkSession) -> str:
    """Shared folder of the cluster; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{working_dir(spark)}/starmart/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, whatever kind that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
