"""Compare a registered query with its SQL oracle, column by name and row by row, order aside."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, Counter, Counter]:
    """Row count, rows only Spark has, rows only the oracle has."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    expected = _bag(names, result.fetchall())
    actual = _bag(df.columns, [tuple(row) for row in df.collect()])
    return sum(actual.values()), actual - expected, expected - actual
