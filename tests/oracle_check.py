"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(df) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        t1 = time.time()
        if name not in sql:
            results[name] = f"rows-only ({len(sdf)} rows)"
            continue
        try:
            rel = con.sql(sql[name])
            dtypes = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
            ddf = rel.df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(e)[:300]}"
            continue
        stypes = {f.name: f.dataType.simpleString() for f in qs[name](spark, sf_dir).schema.fields} if EXACT else dtypes
        if stypes != dtypes:
            results[name] = f"TYPES {sorted(set(stypes.items()) ^ set(dtypes.items()))}"
            continue
        if sorted(sdf.columns) != sorted(ddf.columns):
            results[name] = f"COLUMNS {sorted(sdf.columns)} vs {sorted(ddf.columns)}"
            continue
        a, b = rows_of(sdf), rows_of(ddf)
        if len(a) != len(b):
            results[name] = f"ROWCOUNT {len(a)} vs {len(b)}"
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            results[name] = f"VALUES differ, e.g. {diff}"
        else:
            results[name] = f"ok ({len(a)} rows, spark {t1 - t0:.1f}s)"
        if verbose:
            print(f"{name}: {results[name]}", flush=True)
    return results


if __name__ == "__main__":
    from gradeflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("FAIL", k, v)
