"""Compare a Spark result with a DuckDB statement as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def differences(df, connection, sql: str) -> list[str]:
    """What differs, in words; empty when all is equal."""
    found = []
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if _KINDS.get(kinds[name], kinds[name]) != kind:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        found.append(
            f"rows {sum(actual.values())} != {sum(expected.values())}" if sum(actual.values()) != sum(expected.values()) else "values"
        )
        found.append(f"only Spark: {list((actual - expected).items())[:3]}")
        found.append(f"only SQL: {list((expected - actual).items())[:3]}")
    return found
