"""Run a registered query in Spark and its SQL oracle in DuckDB; compare results."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    s_sorted, d_sorted = sorted(s_cols), sorted(d_cols)
    if s_sorted != d_sorted:
        return False, f"columns differ: spark-only {set(s_cols)-set(d_cols)} duck-only {set(d_cols)-set(s_cols)}"
    s_rows = [tuple(_norm(r[c]) for c in s_sorted) for r in spark_df.collect()]
    idx = [d_cols.index(c) for c in s_sorted]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    s_rows.sort(key=_key)
    d_rows.sort(key=_key)
    for a, b in zip(s_rows, d_rows):
        if a != b:
            diffs = [(c, x, y) for c, x, y in zip(s_sorted, a, b) if x != y]
            return False, f"first differing row: {diffs[:5]}"
    return True, f"{len(s_rows)} rows match"
