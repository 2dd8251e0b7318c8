"""Runs a query and its SQL on the same tables and compares columns, row counts and values without regard to order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def value(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, value(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    try:
        return value(float(v)) if float(v) != int(v) else int(v)
    except (TypeError, ValueError, OverflowError):
        return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    norm = lambda x: int(x) if isinstance(x, float) and x == int(x) else x
    return Counter(tuple(norm(value(r[k])) for k in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def compare(spark, query, sql: str, sf_dir: str, con=None) -> str:
    """Empty if equal, else what differs."""
    con = con or connect(sf_dir)
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want = rows_of(cols, rel.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} and {sorted(cols)}"
    if got != want:
        a, b = got - want, want - got
        return f"{sum(got.values())} and {sum(want.values())} rows; only here {list(a)[:2]}; only there {list(b)[:2]}"
    return ""
