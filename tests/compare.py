"""Row-by-row comparison of a Spark result with DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` when both sides give the same columns, types and rows."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in want.description}
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    wrong = {n: (t, types[n]) for n, t in df.dtypes if kinds.get(t) != types[n]}
    expected = rows_of(names, want.fetchall())
    found = rows_of(df.columns, df.collect())
    if found != expected:
        extra, lost = found - expected, expected - found
        return (
            f"{sum(found.values())} rows, expected {sum(expected.values())}; "
            f"only Spark {list(extra.items())[:3]}; only SQL {list(lost.items())[:3]}"
        )
    return f"types differ: {wrong}" if wrong else None
