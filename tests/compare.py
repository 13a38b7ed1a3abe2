"""Spark results against DuckDB results, without regard to order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(actual: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when equal, else a description of what differs."""
    answer = connection.execute(sql)
    columns = [c[0] for c in answer.description]
    if sorted(columns) != sorted(actual.columns):
        return f"columns {sorted(actual.columns)} against {sorted(columns)}"
    expected, got = bag(columns, answer.fetchall()), bag(actual.columns, actual.collect())
    if expected == got:
        return ""
    extra, lacking = got - expected, expected - got
    return (
        f"{sum(got.values())} rows against {sum(expected.values())}; "
        f"extra {list(extra)[:2]}, lacking {list(lacking)[:2]}"
    )
