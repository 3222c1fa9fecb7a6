"""Run a registered Spark query and its DuckDB oracle on the same tables
and compare row count, column names and an order-insensitive value hash
(the same checks the correctness gate records)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(norm(r[i]) for i in order) for r in rows) if rows else []
    return [cols[i] for i in order], out


def digest(rows) -> str:
    h = hashlib.sha1()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None):
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    diff = None
    if sr != dr:
        sset, dset = set(sr), set(dr)
        only_s = sorted(sset - dset, key=repr)[:3]
        only_d = sorted(dset - sset, key=repr)[:3]
        diff = {"only_spark": only_s, "only_duck": only_d}
    return {"name": name, "rows": (len(sr), len(dr)), "cols_equal": sc == dc,
            "spark_cols": sc, "duck_cols": dc, "values_equal": sr == dr, "diff": diff}
