"""Order-insensitive comparison of a Spark result with DuckDB oracle SQL
(used by scripts/oracle_check.py and the tests)."""

from __future__ import annotations

import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> dict:
    srows, scols = df.collect(), df.columns
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    a, b = canonical(scols, srows), canonical(dcols, drows)
    return {"spark_rows": len(srows), "oracle_rows": len(drows),
            "columns": sorted(scols) == sorted(dcols),
            "values": sorted(scols) == sorted(dcols) and a == b,
            "only_spark": list(set(a) - set(b))[:3], "only_oracle": list(set(b) - set(a))[:3]}
