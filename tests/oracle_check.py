"""Compares a registered query with its SQL: schema names, row count and values."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}") + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str):
    """Empty when both sides agree, else a short account of the difference."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, found.fetchall())
    have = rows_of(df.columns, df.collect())
    if want == have:
        return ""
    return f"{sum(have.values())} rows against {sum(want.values())}; only here {list((have - want).items())[:3]}; only there {list((want - have).items())[:3]}"
