"""Spark-vs-DuckDB comparison, the way the correctness gate does it.

Columns are sorted by name; rows are compared as sorted multisets of value
tuples.  Usable as a script: ``python tests/compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return cols, sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    out = [tuple(_norm(r[i]) for i in idx) for r in data]
    return cols, sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sc, sr = rows_of_spark(fn(spark, sf_dir))
    t1 = time.time()
    dc, dr = rows_of_duck(con, sql)
    ok = sc == dc and sr == dr
    detail = ""
    if sc != dc:
        detail = f"columns spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        detail = f"rows spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        detail = f"values differ e.g. {bad}"
    return ok, len(sr), t1 - t0, detail


def main(argv):
    from pyspark.sql import SparkSession  # noqa: F401
    from pluvio.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in sq:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:32s} ROWS-ONLY rows={n}")
            continue
        try:
            ok, n, dt, detail = compare(spark, con, name, qs[name], sq[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, dt, detail = False, -1, 0.0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={n:<7d} {dt:6.2f}s {detail}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
