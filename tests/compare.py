"""Comparison of a query with its DuckDB statement, by sorted rows."""

import math
import os

import duckdb


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    if hasattr(v, "hour"):
        return v.replace(tzinfo=None).isoformat()
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())


def duck_rows(sql, folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    r = con.sql(sql)
    cols = sorted(r.columns)
    at = [r.columns.index(c) for c in cols]
    return cols, sorted(repr([plain(x[i]) for i in at]) for x in r.fetchall())
