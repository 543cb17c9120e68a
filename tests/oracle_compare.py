"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_con(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        # pandas turns whole numbers into floats where a column has a null
        return int(v) if v.is_integer() else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, out


def digest(rows):
    hs = sorted(hashlib.sha1(repr(r).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


def compare(spark_df, con, sql):
    s_pdf = spark_df.toPandas()
    d_pdf = con.execute(sql).df()
    s_cols, s_rows = rows_of(s_pdf)
    d_cols, d_rows = rows_of(d_pdf)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duck={len(d_rows)}")
    if not problems and digest(s_rows) != digest(d_rows):
        ss, dd = set(s_rows), set(d_rows)
        problems.append(f"values differ: only spark={sorted(ss - dd, key=repr)[:3]} only duck={sorted(dd - ss, key=repr)[:3]}")
    return problems, len(s_rows)
