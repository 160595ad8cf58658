"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py SF_DIR [key ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (bool,)):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if False else str(v)
    return str(v)


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(rows, key=lambda r: tuple((x is None, x or "") for x in r))


def compare(spark, con, key, fn, sql, sf_dir, sdf=None):
    t0 = time.time()
    sdf = fn(spark, sf_dir) if sdf is None else sdf
    rows = sdf.collect()
    s = pd.DataFrame([tuple(r) for r in rows], columns=sdf.columns, dtype=object)
    t1 = time.time()
    if sql is None:
        return key, "rows-only", len(s), None, t1 - t0
    rel = con.sql(sql)
    names = rel.columns
    dtypes = {n: str(ty) for n, ty in zip(names, rel.types)}
    d = pd.DataFrame(rel.fetchall(), columns=names, dtype=object)
    if sorted(s.columns) != sorted(d.columns):
        return key, "SCHEMA", len(s), len(d), t1 - t0, sorted(s.columns), sorted(d.columns)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    tdiff = {c: (stypes[c], dtypes[c]) for c in stypes if stypes[c] != dtypes[c]}
    if tdiff:
        return key, "TYPES", len(s), len(d), t1 - t0, tdiff
    cs, cd = canon(s), canon(d)
    if cs == cd:
        return key, "ok", len(s), len(d), t1 - t0
    diff = [(a, b) for a, b in zip(cs, cd) if a != b][:2]
    return key, "VALUES", len(s), len(d), t1 - t0, diff


def main():
    sys.path.insert(0, ".")
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import __spark_entry__ as E
    from vehiscope.session import get_spark
    spark = get_spark(os.environ.get("ORACLE_MASTER", "local[8]"))
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        try:
            res = compare(spark, con, k, qs[k], os_.get(k), sf_dir)
        except Exception as e:  # report and continue
            res = (k, "ERROR", repr(e)[:400])
        if res[1] not in ("ok", "rows-only"):
            bad += 1
        print(*res, flush=True)
    print("BAD", bad, "of", len(keys or qs))


if __name__ == "__main__":
    main()
