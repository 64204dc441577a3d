"""Baseline on the same engine: run the *reference-shaped* SQL of the headline
queries (the oracle SQL: one dedup per technology, hourly join then group,
join-then-aggregate for the daily KPIs) through Spark SQL on the same session
settings as bench.py, and time it the same way (median of 3 after a warm-up,
executed through the noop sink). Prints one JSON line."""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from bench import HEADLINE  # noqa: E402
from kilowatt.plans.oracle import ORACLE  # noqa: E402
from kilowatt.session import local_session  # noqa: E402


def to_spark(sql: str) -> str:
    sql = sql.replace("HUGEINT", "DECIMAL(38,0)").replace(" // ", " div ").replace('"timestamp"', "`timestamp`")
    sql = re.sub(r"strftime\((\w+), '%Y-%m'\)", r"date_format(\1, 'yyyy-MM')", sql)
    return sql


def register_tables(spark, sf: str, sql: str) -> None:
    """Views of the tables that ``sql`` reads (opened each time, as the queries do)."""
    for t in re.findall(r"\b(?:FROM|JOIN) (region|nation|customer|orders|lineitem|events)\b", sql):
        spark.read.parquet(f"{sf}/{t}.parquet").createOrReplaceTempView(t)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus), app="reference-shape")
    out = {}
    for name in sys.argv[1:] or HEADLINE:
        q = to_spark(ORACLE[name])

        def run():
            t0 = time.perf_counter()
            register_tables(spark, sf, q)
            spark.sql(q).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            run()
            out[name] = round(statistics.median(run() for _ in range(3)), 3)
        except Exception as e:  # noqa: BLE001
            out[name] = f"error: {type(e).__name__}: {str(e)[:120]}"
    print(json.dumps({"engine": "spark-sql reference shape", "sf": sf, "cpus": cpus, "queries": out}))


if __name__ == "__main__":
    main()
