"""Side-by-side check of a registered Spark query against its DuckDB oracle:
row count, column names, and an order-insensitive comparison of values."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in tuples]
    return sorted(out, key=repr), [columns[i] for i in order]


def spark_rows(df):
    cols = df.columns
    return _rows(cols, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return _rows(cols, cur.fetchall())


def compare(spark, name, fn, sql, sf_dir, con=None):
    """Return (ok, message)."""
    con = con or duck_conn(sf_dir)
    s_rows, s_cols = spark_rows(fn(spark, sf_dir))
    d_rows, d_cols = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows spark={len(s_rows)} duck={len(d_rows)}"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    if bad:
        return False, f"{name}: {len(bad)} differing rows, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{name}: ok ({len(s_rows)} rows)"
