"""Run a Spark query and its DuckDB statement on the same parquet tables and
compare row count, column names and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

from risingtide.sources.driver import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact=False):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v) or exact:
            return v
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, exact) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, exact)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), exact)
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    return v


def _key(row):
    return tuple((x is None, "" if x is None else repr(x)) for x in row)


def compare(spark_df, con, sql: str, exact: bool = False) -> dict:
    """``exact``: floats must be bit-identical (default: equal to 10
    significant digits)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols)}
    if sorted(s_cols) != sorted(d_cols):
        res["match"] = False
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i], exact) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i], exact) for i in di) for r in d_rows), key=_key)
    res["match"] = a == b
    if not res["match"]:
        diff = [x for x in a if x not in b][:3]
        res["spark_only"] = diff
        res["oracle_only"] = [x for x in b if x not in a][:3]
    return res
