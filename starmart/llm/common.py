"""What the operators share: tables, one-row-at-a-time work in Arrow batches, data splits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows that one call of a worker function gets; bounds the Python objects alive at once.
ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_column(
    df: DataFrame, name: str, kind: T.DataType, make: Callable[[], Callable[..., Sequence]], *inputs: str
) -> DataFrame:
    """``df`` with a column computed in Python, all other columns handed through as they are.

    ``make`` is called once in a task and returns a function from lists of the ``inputs``
    to the list of results. A column that has the name already is replaced.
    """
    fields = df.schema.fields
    keep = [i for i, f in enumerate(fields) if f.name.lower() != name.lower()]
    places = [[f.name.lower() for f in fields].index(c.lower()) for c in inputs]
    schema = T.StructType([*(fields[i] for i in keep), T.StructField(name, kind)])
    names, made = schema.names, to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                values = work(*(part.column(i).to_pylist() for i in places))
                columns = [part.column(i) for i in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values, made)], names=names)

    return df.mapInArrow(run, schema)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def held_out(key: Column, modulus: int, value: int) -> Column:
    """Whether a row is kept from learning; a row without a key is not held out."""
    return F.coalesce(remainder(key, modulus) == value, F.lit(False))


def at_most(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """All rows if there are at most ``rows``; else about as many, picked by a hash of ``columns``."""
    total = df.count()
    if total <= rows:
        return df
    share = F.pmod(F.xxhash64(*columns), F.lit(1 << 40))
    return df.where(share < (rows << 40) // total)
