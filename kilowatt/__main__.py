"""Command line: run the medallion jobs on the active cluster.

    spark-submit --py-files kilowatt.zip -m kilowatt all --landing s3a://.../landing --lake s3a://.../lake
    python -m kilowatt silver --lake /data/lake
    python -m kilowatt merge --lake /data/lake --source /data/corrections --as-of 2024-01-30
    python -m kilowatt incremental --landing /data/landing --lake /data/lake

The session comes from ``SparkSession.builder.getOrCreate()`` (master and
resources from spark-submit); ``spark.checkpoint.dir`` must name shared
storage on a cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kilowatt", description=__doc__.splitlines()[0])
    p.add_argument("job", choices=["bronze", "silver", "gold", "all", "merge", "incremental", "inventory"])
    p.add_argument("--landing", help="landing folder with sites*.csv, solar*.csv, wind*.csv")
    p.add_argument("--lake", required=True, help="lake root (bronze/, silver/, gold/)")
    p.add_argument("--source", help="merge: parquet folder of silver-shaped rows to upsert")
    p.add_argument("--as-of", help="merge: date the delete window counts back from (default today)")
    p.add_argument("--recent-days", type=int, default=7, help="merge: delete window in days")
    p.add_argument("--no-delete", action="store_true",
                   help="merge: keep target rows missing from the source (corrections only)")
    a = p.parse_args(argv)

    from kilowatt.plans import medallion
    from kilowatt.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName(f"kilowatt-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    lake = medallion.Lake(a.lake)
    out: dict = {"job": a.job}
    if a.job in ("bronze", "all"):
        if not a.landing:
            p.error("--landing is required for bronze")
        out["bronze_quality"] = {k: {m: str(v) for m, v in d.items()}
                                 for k, d in medallion.bronze_job(spark, a.landing, lake).items()}
    if a.job in ("silver", "all"):
        out["silver_version"] = medallion.silver_job(spark, lake)
    if a.job in ("gold", "all"):
        medallion.gold_job(spark, lake)
    if a.job == "merge":
        from kilowatt.sinks import versioned
        if not a.source:
            p.error("--source is required for merge")
        as_of = dt.date.fromisoformat(a.as_of) if a.as_of else None
        out["silver_version"] = versioned.merge_into(lake.table("silver", "production"),
                                                     spark.read.parquet(a.source), as_of=as_of,
                                                     recent_days=None if a.no_delete else a.recent_days)
    if a.job == "incremental":  # new landing files merged into silver, then the touched days of gold
        if not a.landing:
            p.error("--landing is required for incremental")
        out["silver_dates"] = len(medallion.live_silver_job(spark, a.landing, lake))
        out["gold_dates"] = len(medallion.live_gold_job(spark, lake))
    if a.job == "inventory":
        from kilowatt.operators.layout import layer_inventory
        out["tables"] = [r.asDict() for r in layer_inventory(spark, lake.tables()).collect()]  # one per table
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
