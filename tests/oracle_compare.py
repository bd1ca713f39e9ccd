"""Spark result vs DuckDB oracle: row count, column names, multiset of rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "asDict") or isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return float(f"{float(v):.9g}")
    return v


def compare(cols, rows, ocols, orows):
    """-> (same_columns, same_count, same_values, only_spark, only_oracle)."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = Counter(tuple(norm(r[i]) for i in order) for r in rows)
    b = Counter(tuple(norm(r[i]) for i in oorder) for r in orows)
    return sorted(cols) == sorted(ocols), len(rows) == len(orows), a == b, a - b, b - a
