"""The issue report over a written mart."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..contracts import CONTRACTS, TableContract
from .checks import (
    check_foreign_key, check_not_null, check_primary_key, check_types, check_unique,
)


def check_table(
    df: DataFrame, contract: TableContract, tables: Mapping[str, DataFrame] | None = None,
    written: StructType | None = None,
) -> DataFrame:
    """Every check the contract asks for, as one frame of report rows.

    Foreign keys are checked against the parents found in ``tables``; a key whose parent is
    absent has a row with status ``skipped``. Types are checked against the schema ``written``
    in the files when it is given.
    """
    parts = [
        check_types(df, contract, written),
        check_primary_key(df, contract.name, contract.primary_key),
    ]
    if contract.not_null:
        parts.append(check_not_null(df, contract.name, contract.not_null))
    parts += [check_unique(df, contract.name, c) for c in contract.unique]
    for foreign_key in contract.foreign_keys:
        parent = (tables or {}).get(foreign_key.parent)
        if parent is not None:
            parts.append(check_foreign_key(df, parent, contract.name, foreign_key))
        else:
            skipped = (contract.name, "foreign_key", foreign_key.label, None, "skipped")
            parts.append(df.sparkSession.createDataFrame([skipped], parts[0].schema))
    return reduce(DataFrame.unionByName, parts)


def check_mart(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = CONTRACTS,
    written: Mapping[str, StructType] | None = None, parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The report of all given tables; ``parents`` are further ones that keys may refer to."""
    known = {**(parents or {}), **tables}
    return reduce(DataFrame.unionByName, [
        check_table(df, contracts[name], known, (written or {}).get(name))
        for name, df in tables.items()
    ])
