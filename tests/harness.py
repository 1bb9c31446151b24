"""Local re-implementation of the driver's oracle comparison.

Runs a registered Spark query and its DuckDB oracle over the same parquet
directory and compares row count, column names and an order-insensitive
hash of the values (columns sorted by name).  ``exact`` requires bit-equal
values; the loose check rounds floats to 9 significant digits.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, loose: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if loose:
            return float(f"{v:.9g}")
        return v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), loose)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, loose) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _digest(rows, loose):
    h = sorted(hashlib.sha1(repr(tuple(_norm(x, loose) for x in r)).encode()).hexdigest()
               for r in rows)
    return hashlib.sha1("".join(h).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
        out["exact"] = out["loose"] = False
        return out
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    s_sorted = [tuple(r[i] for i in order_s) for r in s_rows]
    d_sorted = [tuple(r[i] for i in order_d) for r in d_rows]
    out["exact"] = _digest(s_sorted, False) == _digest(d_sorted, False)
    out["loose"] = _digest(s_sorted, True) == _digest(d_sorted, True)
    if not out["loose"]:
        names = sorted(s_cols)
        ss = sorted(map(lambda r: tuple(_norm(x, True) for x in r), s_sorted), key=repr)
        dd = sorted(map(lambda r: tuple(_norm(x, True) for x in r), d_sorted), key=repr)
        for a, b in zip(ss, dd):
            if a != b:
                out["first_diff"] = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
                break
    return out
