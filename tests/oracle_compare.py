"""Run a registered query on Spark and its SQL on DuckDB and compare the results as multisets."""

from __future__ import annotations

import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, list):
        return tuple(value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]


def differences(left, right, show: int = 3) -> str | None:
    (left_names, left_rows), (right_names, right_rows) = left, right
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    a, b = Counter(left_rows), Counter(right_rows)
    if a == b:
        return None
    return (
        f"{len(left_rows)} rows / {len(right_rows)} rows; only Spark {list((a - b).items())[:show]}; "
        f"only SQL {list((b - a).items())[:show]}"
    )
