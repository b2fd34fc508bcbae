"""Compare a Spark DataFrame with a DuckDB oracle query on the same tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = False


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if STRICT else round(v, 6)
    if hasattr(v, "isoformat"):
        iso = v.isoformat()
        # A DATE may arrive as a midnight timestamp from one engine.
        return iso[:10] if (type(v).__name__ == "date" or iso.endswith("T00:00:00")) else iso
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except Exception:
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, sql: str, con) -> dict:
    s = spark_df.toPandas()
    s = s.astype(object).where(pd.notnull(s), None)
    o = con.execute(sql).df()
    o = o.astype(object).where(pd.notnull(o), None)
    res = {"spark_rows": len(s), "oracle_rows": len(o),
           "cols_match": sorted(s.columns) == sorted(o.columns)}
    if STRICT and res["cols_match"]:
        kinds = {c: (s[c].map(lambda x: type(x).__name__).value_counts().index.tolist()[:2],
                     o[c].map(lambda x: type(x).__name__).value_counts().index.tolist()[:2]) for c in s.columns}
        res["type_diff"] = {c: k for c, k in kinds.items() if set(k[0]) - {"NoneType"} != set(k[1]) - {"NoneType"}}
    if not res["cols_match"]:
        res["spark_only"] = sorted(set(s.columns) - set(o.columns))[:10]
        res["oracle_only"] = sorted(set(o.columns) - set(s.columns))[:10]
        res["ok"] = False
        return res
    rs, ro = _rows(s), _rows(o)
    diff = 0
    first = None
    for a, b in zip(rs, ro):
        if a != b:
            diff += 1
            if first is None:
                first = (a, b)
    res["rows_differ"] = diff + abs(len(rs) - len(ro))
    if first:
        cols = sorted(s.columns)
        res["first_diff"] = [(c, x, y) for c, x, y in zip(cols, *first) if x != y][:6]
    res["ok"] = res["rows_differ"] == 0 and len(rs) == len(ro)
    return res
