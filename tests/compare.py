"""Compares a Spark result with the expected SQL run by DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, connection, statement: str) -> str | None:
    """What differs, or ``None``. Types must match too: no number is rounded."""
    got = frame.collect()
    result = connection.execute(statement)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    left, right = _rows(frame.columns, got), _rows(names, expected)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if repr(a) != repr(b):
            return f"columns {sorted(names)}\n spark {a}\n  sql  {b}"
    return None
