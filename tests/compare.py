"""Comparison of a query with its SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _sortable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    return (1, repr(value))


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Rows with columns by name, in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda row: [_sortable(v) for v in row])


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(row) for row in frame.collect()])


def sql_rows(connection, sql: str):
    cursor = connection.execute(sql)
    return rows_of([column[0] for column in cursor.description], cursor.fetchall())
