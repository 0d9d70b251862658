"""SAS data files read by Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

Decoder = Callable[[str], Iterator[pd.DataFrame]]


def _open(path: str):
    """A seekable stream on a local or remote file; the file is never loaded whole."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    elif scheme == "file":
        path = "/" + rest.lstrip("/")
    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def sas_decoder(chunk_rows: int, file_format: str, encoding: str) -> Decoder:
    def decode(path: str) -> Iterator[pd.DataFrame]:
        with _open(path) as stream, pd.read_sas(
            stream, format=file_format, encoding=encoding, chunksize=chunk_rows
        ) as chunks:
            yield from chunks

    return decode


def read_sas(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    chunk_rows: int = 50_000,
    file_format: str = "sas7bdat",
    encoding: str = "latin-1",
    decode: Decoder | None = None,
) -> DataFrame:
    """All SAS files under a path or glob as one frame with the columns of ``schema``.

    Spark lists the files and gives each to a task, which decodes it in chunks of
    ``chunk_rows`` rows. Only paths are scanned, not contents. The format can only be read
    from front to back, so the files are the unit of parallel work; land the result
    as Parquet before using it more than once.
    """
    decode = decode or sas_decoder(chunk_rows, file_format, encoding)
    names = {f.name.lower(): f for f in schema.fields}

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["path"]:
                for chunk in decode(file):
                    yield _conform(chunk, names)

    paths = (
        spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
        .select("path")
    )
    return paths.mapInPandas(chunks, schema)


def _conform(chunk: pd.DataFrame, names: dict) -> pd.DataFrame:
    """Columns of the schema, matched without regard to case; absent ones are empty."""
    chunk = chunk.rename(columns=str.lower)
    out = {}
    for lower, field in names.items():
        values = chunk.get(lower, pd.Series([None] * len(chunk), index=chunk.index, dtype=object))
        if isinstance(field.dataType, StringType):
            values = values.astype(object).where(values.notna() & (values != ""), None)
        elif isinstance(field.dataType, (IntegerType, LongType)):
            # SAS numbers are doubles; whole-number columns are cut toward zero
            values = np.trunc(pd.to_numeric(values).astype("float64")).astype("Int64")
        out[field.name] = values
    return pd.DataFrame(out)
