"""CSV and Parquet readers, typed schemas of the known sources, source selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType, FloatType, IntegerType, StringType, StructField, StructType,
)

from ..functions import cast_column
from ..sinks.aligned import PART, layout_of, read_aligned
from ..sinks.stage import stage
from ..sinks.versions import current_version, files_of, read_files
from .sas import read_sas


def _struct(*columns: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


_TEXT, _FLOAT, _INT = StringType(), FloatType(), IntegerType()

_CORRUPT = "_corrupt_record"

# Default file names below the base path, and the columns of the files.
SOURCE_FILES = {
    "immigration": "data/immigration_data_sample.csv",
    "immigration_sas": "data/immigration/18-83510-I94-Data-2016/*.sas7bdat",
    "labels": "data/I94_SAS_Labels_Descriptions.SAS",
    "temperature": "data/GlobalLandTemperaturesByCity.csv",
    "demography": "data/us-cities-demographics.csv",
    "airport": "data/airport-codes_csv.csv",
}
TEMPERATURE_SCHEMA = _struct(
    ("dt", _TEXT), ("AverageTemperature", _FLOAT), ("AverageTemperatureUncertainty", _FLOAT),
    ("City", _TEXT), ("Country", _TEXT), ("Latitude", _TEXT), ("Longitude", _TEXT),
)
CITY_SCHEMA = _struct(
    ("City", _TEXT), ("State", _TEXT), ("Median Age", _FLOAT), ("Male Population", _FLOAT),
    ("Female Population", _FLOAT), ("Total Population", _INT), ("Number of Veterans", _FLOAT),
    ("Foreign-born", _FLOAT), ("Average Household Size", _FLOAT), ("State Code", _TEXT),
    ("Race", _TEXT), ("Count", _INT),
)
AIRPORT_SCHEMA = _struct(
    ("ident", _TEXT), ("type", _TEXT), ("name", _TEXT), ("elevation_ft", _FLOAT),
    ("continent", _TEXT), ("iso_country", _TEXT), ("iso_region", _TEXT), ("municipality", _TEXT),
    ("gps_code", _TEXT), ("iata_code", _TEXT), ("local_code", _TEXT), ("coordinates", _TEXT),
)
# The columns used of the binary arrival files, where numbers and dates are doubles.
IMMIGRATION_SCHEMA = _struct(
    ("cicid", DoubleType()), ("i94yr", DoubleType()), ("i94mon", DoubleType()),
    ("i94port", _TEXT), ("i94addr", _TEXT), ("arrdate", DoubleType()), ("depdate", DoubleType()),
    ("i94mode", DoubleType()), ("i94visa", DoubleType()), ("i94cit", DoubleType()),
    ("i94res", DoubleType()), ("biryear", DoubleType()), ("gender", _TEXT), ("insnum", _TEXT),
    ("airline", _TEXT), ("admnum", DoubleType()), ("fltno", _TEXT), ("visatype", _TEXT),
)


def source_path(base: str, name: str) -> str:
    """Default location of a source below a base path; ``base`` is any URI Spark can read."""
    return SOURCE_FILES[name] if not base else f"{base.rstrip('/')}/{SOURCE_FILES[name]}"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    schema: StructType | None = None,
    null_values: Iterable[str] = (),
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row.

    Without ``schema`` every column is text under its header name: one line is read,
    no types are inferred. Every file's header must list the columns of the schema, or
    of the first file (a changed file fails instead of shifting values). A cell that is no
    value of its type becomes NULL and its row is kept in ``corrupt_column`` when one is named. Without
    ``schema`` that column holds the lines whose number of cells is not the header's: too short, too long, or with
    a quote that is never closed and so takes the delimiters after it (in the last cell it takes none).
    ``null_values`` are further texts that mean a missing value.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("multiLine", multi_line)
        .option("enforceSchema", False)
    )
    if schema is None and corrupt_column:
        schema = reader.csv(path).schema
    if schema is not None:
        if corrupt_column:
            schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema).option("mode", "PERMISSIVE")
    df = reader.csv(path)
    missing = list(null_values)
    if not missing:
        return df
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*missing), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, StringType) and f.name != corrupt_column else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns of ``schema`` by name; cells that are no value of the type become NULL."""
    return df.select(*[
        cast_column(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_source(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", **options
) -> DataFrame:
    """One source in the format at hand: ``csv``, ``sas`` or ``parquet``."""
    if fmt == "csv":
        return read_csv(spark, path, **options)
    if fmt == "sas":
        return read_sas(spark, path, options.pop("schema", IMMIGRATION_SCHEMA), **options)
    if fmt == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unknown source format {fmt!r}")


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: StructType | None = None
) -> DataFrame:
    """A written mart table, the version in force of one kept as versions, the latest parts of an aligned one; filters on its partition columns prune directories.

    ``schema`` saves the look into a file footer and fixes the partition column's type.
    """
    if layout_of(spark, path) is not None:
        df = read_aligned(spark, path, schema if schema is not None else stored_schema(spark, path))
    elif current_version(spark, path) is not None:
        df = read_files(spark, path, schema if schema is not None else stored_schema(spark, path))
    else:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
    return df.select(*columns) if columns else df


def stored_schema(spark: SparkSession, path: str) -> StructType:
    """The columns and types found in the files of a table, and the partition columns after them."""
    if layout_of(spark, path) is not None:
        return StructType([f for f in spark.read.parquet(f"{path}/data").schema.fields if f.name != PART])
    if current_version(spark, path) is None:
        return spark.read.parquet(path).schema
    first = files_of(spark, path).select("file").first()
    if first is None:
        return StructType([])
    schema = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data/{first[0]}").schema
    return StructType([f for f in schema.fields if f.name != "batch"])


def local_table(spark: SparkSession, rows, schema: StructType | str | None = None) -> DataFrame:
    """A small driver-side collection or pandas frame as a table."""
    return spark.createDataFrame(list(rows.items()) if isinstance(rows, dict) else rows, schema)


def land_apart(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], name: str, folder: str | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """A CSV source stored once: the used columns of its whole lines, and apart (file, block, line) of the malformed ones.

    ``block`` is where the split of the file begins that holds the line. ``options`` are those of :func:`read_csv`.
    """
    df = read_csv(spark, path, corrupt_column=_CORRUPT, **options)
    if absent := [c for c in columns if c not in df.columns]:
        raise ValueError(f"source {name} lacks the columns {absent}")
    malformed = F.col(_CORRUPT).isNotNull()
    place = [
        F.when(malformed, F.col(f"_metadata.{c}")).alias(a)
        for c, a in (("file_path", "__file"), ("file_block_start", "__block"))
    ]
    stored = stage(df.select(*[F.col(f"`{c}`") for c in columns], _CORRUPT, *place), f"landed-{name}", folder)
    lines = stored.filter(malformed).select(
        F.col("__file").alias("file"), F.col("__block").alias("block"), F.col(_CORRUPT).alias("line")
    )
    return stored.filter(~malformed).select(*[F.col(f"`{c}`") for c in columns]), lines


def land(
    df: DataFrame, columns: Sequence[str], name: str, folder: str | None = None
) -> DataFrame:
    """Store the used columns of a row-format source once as Parquet.

    Several tables are cut from one source; each then reads only its own columns
    instead of parsing every row again, and row counts come from file footers.
    """
    return stage(df.select(*[F.col(f"`{c}`") for c in columns]), f"landed-{name}", folder)
