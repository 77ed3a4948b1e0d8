"""Side-by-side check of a ``queries()`` entry against its ``oracle_sql()`` twin in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

# ORACLE_EXACT=1 compares doubles bit for bit (no rounding in the harness).
EXACT = os.environ.get("ORACLE_EXACT") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if EXACT else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean"}


def compare(spark, con, key: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_types = dict(sdf.dtypes)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {n: DUCK_TO_SPARK.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    d_rows = [tuple(r) for r in rel.fetchall()]
    out = {"key": key, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols),
           "types_match": s_types == d_types}
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(s_cols), sorted(d_cols)
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    exact = sum(1 for a, b in zip(s, d) if a == b)
    out["exact_rows"] = exact
    out["ok"] = len(s) == len(d) and exact == len(s)
    if not out["ok"]:
        bad = [(a, b) for a, b in zip(s, d) if a != b][:3]
        out["examples"] = bad
    return out
