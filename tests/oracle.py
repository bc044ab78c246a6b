"""Compare a registered query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else 0.0 if value == 0 else value
    return value


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_table(frame):
    return _sorted(frame.columns, [tuple(row) for row in frame.collect()])


def sql_table(connection, text: str):
    cursor = connection.execute(text)
    columns = [d[0] for d in cursor.description]
    return _sorted(columns, cursor.fetchall())


def difference(frame, connection, text: str) -> str | None:
    """None when both results are equal, else a short description."""
    names, ours = spark_table(frame)
    other_names, theirs = sql_table(connection, text)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, columns {names}, first: {wrong[0][0]} != {wrong[0][1]}"
    return None
