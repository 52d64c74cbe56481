"""Run a registered query on Spark and its SQL on DuckDB, and compare rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def normal(columns, rows):
    """Rows with columns in name order, sorted, so that order does not matter."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        return repr(v)

    names = [columns[i] for i in order]
    return names, sorted(tuple(value(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    return normal([c[0] for c in result.description], result.fetchall())
