"""Compares a Spark result with the SQL result on the same tables, ignoring row order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both agree, else what differs."""
    ours = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if ours == theirs:
        return ""
    left, right = ours - theirs, theirs - ours
    some = [str(list(c)[:2]) for c in (left, right)]
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows, {sum(left.values())} only ours {some[0]}, {sum(right.values())} only SQL {some[1]}; columns {sorted(names)}"
