"""The data dictionary as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contracts import CONTRACTS, TableContract

_SCHEMA = (
    "table_name string, position int, column_name string, description string, "
    "data_type string, example string"
)


def data_dictionary(
    spark: SparkSession,
    tables: Mapping[str, DataFrame] | None = None,
    contracts: Mapping[str, TableContract] = CONTRACTS,
) -> DataFrame:
    """One row per contract column: table, position, column, description, type, example.

    With ``tables`` the type each column has in the live table is added as ``found_type``.
    """
    rows = [
        (c.name, i, f.name, f.metadata.get("comment"), f.dataType.simpleString(), c.examples.get(f.name))
        for c in contracts.values()
        for i, f in enumerate(c.schema.fields)
    ]
    dictionary = spark.createDataFrame(rows, _SCHEMA)
    if tables is None:
        return dictionary
    live = [(name, column, dtype) for name, df in tables.items() for column, dtype in df.dtypes]
    found = spark.createDataFrame(live, "table_name string, column_name string, found_type string")
    return dictionary.join(found, ["table_name", "column_name"], "left").select(
        *dictionary.columns, F.col("found_type")
    )
