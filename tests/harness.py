"""Run a registered query in Spark and its SQL in DuckDB, then compare results.

Usage: python tests/harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, places=9):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, places)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, places) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item(), places)
    return v


def rows_of(pdf, places=9):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, places) for v in rec))
    return cols, sorted(out, key=repr)


def compare(spark_pdf, duck_pdf, places=9):
    cs, rs = rows_of(spark_pdf, places)
    cd, rd = rows_of(duck_pdf, places)
    if cs != cd:
        return f"columns differ: spark={cs} duck={cd}"
    if len(rs) != len(rd):
        return f"row count differs: spark={len(rs)} duck={len(rd)}"
    bad = [(a, b) for a, b in zip(rs, rd) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return None


def run(names=None, sf_dir="/root/testdata/sf0.01", spark=None, verbose=True):
    from simcat.plans.registry import load_all
    from simcat.session import get_spark
    spark = spark or get_spark()
    con = duck_connection(sf_dir)
    qs = load_all()
    failures = {}
    for name, qy in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sp = qy.build(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            failures[name] = f"spark error: {str(e)[:500]}"
            print(f"{name:28s} SPARK ERROR {str(e)[:500]}")
            continue
        t1 = time.time()
        if qy.sql is None:
            print(f"{name:28s} rows={len(sp):6d} spark={t1-t0:5.1f}s (no oracle)")
            continue
        try:
            dk = con.execute(qy.sql).df()
        except Exception as e:  # noqa: BLE001
            failures[name] = f"duck error: {str(e)[:500]}"
            print(f"{name:28s} DUCK ERROR {str(e)[:500]}")
            continue
        t2 = time.time()
        msg = compare(sp, dk)
        strict = compare(sp, dk, places=15)
        status = "OK" if msg is None else "MISMATCH " + msg
        if msg is None and strict is not None:
            status = "OK (differs beyond 9 places: " + strict[:200] + ")"
        if msg is not None:
            failures[name] = msg
        if verbose:
            print(f"{name:28s} rows={len(sp):6d} spark={t1-t0:5.1f}s duck={t2-t1:5.1f}s {status}")
    return failures


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    f = run(set(args) or None, sf)
    print("FAILURES:", len(f))
