"""Comparison of a query result with its SQL counterpart."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description of the first difference."""
    left_columns, left = spark_rows(df)
    right_columns, right = sql_rows(con, sql)
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    if len(left) != len(right):
        extra = [r for r in left if r not in set(right)][:2]
        return f"{len(left)} rows != {len(right)} rows, e.g. {extra}"
    for a, b in zip(left, right):
        if a != b:
            return "; ".join(f"{c}: {x} != {y}" for c, x, y in zip(left_columns, a, b) if x != y) + f" in {a}"
    return None
