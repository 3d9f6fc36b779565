"""Run a query and its SQL on one folder and compare: names, row count, values in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    """One spelling per value; numbers of different SQL types compare by value."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, int):
        return decimal.Decimal(value).normalize() + 0
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    found = rows_of(df.columns, df.collect())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if expected != found:
        problems.append(f"{sum(found.values())} rows, expected {sum(expected.values())}")
        problems.append(f"extra: {list((found - expected).items())[:3]}")
        problems.append(f"missing: {list((expected - found).items())[:3]}")
    return problems
