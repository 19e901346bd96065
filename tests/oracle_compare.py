"""Run a registered Spark query and its DuckDB oracle on the same star-schema
directory and compare row count, column names and the multiset of rows."""

from __future__ import annotations

import collections
import decimal
import math
import os

import duckdb

STAR_VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents")


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in STAR_VIEWS:
        if t == "documents" and not os.path.exists(f"{sf_dir}/{t}.parquet"):
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, int):
        return format(decimal.Decimal(v), "f")
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [cols[i] for i in order]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows, s_sorted = _rows(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows, d_sorted = _rows(d_cols, rel.fetchall())
    res = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": s_sorted == d_sorted,
        "values_match": collections.Counter(s_rows) == collections.Counter(d_rows),
    }
    if not res["columns_match"]:
        res["columns"] = (s_sorted, d_sorted)
    if not res["values_match"]:
        a, b = collections.Counter(s_rows), collections.Counter(d_rows)
        res["only_spark"] = list((a - b).elements())[:3]
        res["only_oracle"] = list((b - a).elements())[:3]
    res["ok"] = res["columns_match"] and res["values_match"] and len(s_rows) == len(d_rows)
    return res
