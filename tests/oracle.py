"""Spark rows against DuckDB rows over the same files."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, Decimal):
        return float(x)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p / '*.parquet' if p.is_dir() else p}'")
    return con


def differences(df, con, sql: str) -> tuple[Counter, Counter]:
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    return got - want, want - got
