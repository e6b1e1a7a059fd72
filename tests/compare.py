"""Spark result against DuckDB result: same columns, same rows in any order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}") + 0.0
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql: str):
    """None when equal, else a short description."""
    left = _sorted(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    right = _sorted(rel.columns, rel.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        extra = [r for r in left[1] if r not in set(right[1])][:2]
        missing = [r for r in right[1] if r not in set(left[1])][:2]
        return f"rows {len(left[1])} != {len(right[1])}; extra {extra}; missing {missing}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{str(a)[:600]} != {str(b)[:600]}"
    if not left[1]:
        return "both empty"
    return None
