"""Compare a registered Spark query with its DuckDB SQL oracle.

Checks row count, column names, a coarse type class per column, and an
order-insensitive hash of the values (columns sorted by name, doubles rounded).
Run as a script to check every key: ``python tests/oracle_check.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark type -> the DuckDB type the oracle must produce for the same column
EXACT_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    return "other"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def value_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for _, r in df.iterrows())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare_frames(sdf, rel) -> dict:
    """Compare a Spark DataFrame with a DuckDB relation."""
    spark_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    left = sdf.toPandas()
    # toPandas turns a nullable int column holding NULLs into float64; undo that
    for c, t in spark_types.items():
        if _kind(t) == "int" and left[c].dtype.kind == "f":
            left[c] = left[c].astype("Int64")
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    right = rel.df()
    res = {"rows": (len(left), len(right)), "cols_match": sorted(left.columns) == sorted(right.columns)}
    if res["cols_match"]:
        res["type_mismatch"] = {
            c: (spark_types[c], duck_types[c])
            for c in left.columns
            if EXACT_TYPES.get(spark_types[c], spark_types[c]) != duck_types[c]
        }
        res["hash_match"] = value_hash(left) == value_hash(right)
    else:
        res["columns"] = (sorted(left.columns), sorted(right.columns))
        res["hash_match"] = False
    res["ok"] = res["hash_match"] and res["rows"][0] == res["rows"][1] and not res.get("type_mismatch")
    return res


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    con = con or duck(sf_dir)
    res = compare_frames(sdf, con.sql(entry.oracle_sql()[name]))
    res["name"] = name
    res["sec"] = round(time.time() - t0, 2)
    return res


if __name__ == "__main__":
    from txrisk.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    names = sys.argv[2:] or list(entry.oracle_sql())
    spark = build_session("local[8]", 8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
