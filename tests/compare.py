"""Row-for-row comparison of a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return _rows(names, result.fetchall())


def difference(df, connection, sql) -> str | None:
    """None if both sides agree in columns, rows and value types; else a description."""
    (names, got), (expected_names, expected) = spark_rows(df), sql_rows(connection, sql)
    if names != expected_names:
        return f"columns {names} <> {expected_names}"
    if got == expected:
        for row, other in zip(sorted(map(repr, got)), sorted(map(repr, expected))):
            if row != other:
                return f"types differ: {row} <> {other}"
        return None
    extra, missing = got - expected, expected - got
    return (f"{sum(got.values())} rows <> {sum(expected.values())}; "
            f"only Spark {list(extra)[:3]}; only SQL {list(missing)[:3]}")
