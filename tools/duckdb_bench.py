"""Time the oracle SQL of the headline queries in DuckDB (single node,
same tables) as a reference point for bench.py. Prints one JSON line."""

import json
import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from bench import HEADLINE  # noqa: E402
from kilowatt.plans.oracle import ORACLE  # noqa: E402

sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
threads = os.environ.get("BENCH_CPUS", "8")
con = duckdb.connect()
con.execute(f"SET threads = {threads}")
for t in ["region", "nation", "customer", "orders", "lineitem", "events"]:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
out = {}
for name in HEADLINE:
    q = f"SELECT COUNT(*) FROM ({ORACLE[name]}) q"
    con.execute(q).fetchall()
    ts = []
    for _ in range(3):
        t0 = time.perf_counter()
        con.execute(q).fetchall()
        ts.append(time.perf_counter() - t0)
    out[name] = round(statistics.median(ts), 3)
print(json.dumps({"engine": "duckdb", "sf": sf, "threads": threads, "queries": out,
                  "total": round(sum(out.values()), 3)}))
