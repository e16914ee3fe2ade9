"""Value comparison of a Spark result with a DuckDB oracle result (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


def compare(spark_df, con, sql):
    s_rows, s_cols = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows, d_cols = rows_of(d_cols, res.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
    elif len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duckdb={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
