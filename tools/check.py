"""Run registered queries and compare them with their SQL on DuckDB.

    python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from fieldlens.plans.catalogue import ORACLES, QUERIES
from fieldlens.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session(
        "check", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
         "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    bad = 0
    for name in args.names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            got = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark {type(exc).__name__}: {str(exc)[:900]}", flush=True)
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows, {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            cur = con.execute(ORACLES[name])
            names = [c[0] for c in cur.description]
            want = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: sql {type(exc).__name__}: {str(exc)[:900]}", flush=True)
            continue
        sql_took = time.time() - start
        a, b = rows_of(df.columns, got), rows_of(names, want)
        types = dict(zip(df.columns, (f.dataType.simpleString() for f in df.schema)))
        if sorted(df.columns) != sorted(names):
            bad += 1
            print(f"FAIL {name}: columns {sorted(df.columns)} vs {sorted(names)}", flush=True)
        elif a != b:
            bad += 1
            left, right = set(a) - set(b), set(b) - set(a)
            print(f"FAIL {name}: {len(a)} vs {len(b)} rows, {len(left)} differ; cols {sorted(df.columns)}\n   spark {sorted(left)[:2]}\n   sql   {sorted(right)[:2]}", flush=True)
        else:
            print(f"ok   {name}: {len(a)} rows, spark {took:.1f}s, sql {sql_took:.1f}s", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    code = main()
    sys.stdout.flush()
    os._exit(1 if code else 0)
