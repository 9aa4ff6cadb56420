"""Compare a Spark result with its SQL twin, run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


# Spark type to the DuckDB type that must stand beside it.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def differences(frame, sql: str, connection) -> list[str]:
    """What differs between a frame and the SQL result; empty when they agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    found = [tuple(row) for row in frame.collect()]
    problems = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    for field in frame.schema:
        kind = field.dataType.simpleString()
        if TYPES.get(kind, kind) != kinds[field.name]:
            problems.append(f"type of {field.name}: {kind} against {kinds[field.name]}")
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows against {len(expected)}")
    _, left = _sorted_rows(frame.columns, found)
    columns, right = _sorted_rows(names, expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ in {columns}, first {wrong[0][0]} against {wrong[0][1]}")
    return problems
