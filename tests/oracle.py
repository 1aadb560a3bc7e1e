"""Compare a query with its DuckDB statement on the driver's smallest tables."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = Path("/root/testdata/sf0.001")


def connection() -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in TABLES.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return float(v) if isinstance(v, int) and abs(v) < 2**53 else v


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(value(r[i]) for i in order) for r in data)


def same(spark, name: str, query, sql: str) -> None:
    df = query(spark, str(TABLES))
    mine = rows(df.columns, df.collect())
    result = connection().execute(sql)
    theirs = rows([x[0] for x in result.description], result.fetchall())
    assert sorted(df.columns) == sorted(x[0] for x in result.description), name
    assert mine == theirs, (name, list((mine - theirs).items())[:3], list((theirs - mine).items())[:3])
