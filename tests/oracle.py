"""Comparing a Spark result with the SQL of another engine, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def _table(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_table(df):
    return _table(df.columns, df.collect())


def sql_table(connection, sql):
    result = connection.execute(sql)
    return _table([d[0] for d in result.description], result.fetchall())
