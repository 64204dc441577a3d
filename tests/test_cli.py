import json

from pyspark.sql import functions as F

from kilowatt.__main__ import main
from kilowatt.session import scratch_path
from kilowatt.sinks import versioned
from kilowatt.sinks.layers import read_layer
from tests.conftest import SF_TINY


def test_cli_all_merge_inventory(spark, capsys):
    from kilowatt.plans.queries import _landing_layout
    root = scratch_path(spark, "t-cli")
    landing = _landing_layout(spark, SF_TINY, root)
    assert main(["all", "--landing", landing, "--lake", f"{root}/lake"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["silver_version"] == 0 and int(out["bronze_quality"]["solar_raw"]["total_rows"]) > 0

    silver = read_layer(spark, f"{root}/lake/silver/production")
    corr = silver.filter(F.col("date") == F.lit("2024-01-10").cast("date")) \
        .withColumn("production_kwh", F.col("production_kwh") + 1)
    corr.write.parquet(f"{root}/corrections")
    assert main(["merge", "--lake", f"{root}/lake", "--source", f"{root}/corrections",
                 "--as-of", "2024-01-30", "--no-delete"]) == 0
    merged = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert merged["silver_version"] == 1
    h = versioned.history(spark, f"{root}/lake/silver/production").first()
    assert h["operation"] == "MERGE" and h["num_updated"] > 0 and h["num_deleted"] == 0

    assert main(["inventory", "--lake", f"{root}/lake"]) == 0
    inv = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["tables"]
    assert {t["table_name"] for t in inv} >= {"silver.production", "gold.daily_kpis"}


def test_incremental_silver_equals_batch_silver(spark):
    from kilowatt.plans import medallion
    from kilowatt.plans.queries import _landing_layout
    root = scratch_path(spark, "t-incr")
    landing = _landing_layout(spark, SF_TINY, root)
    lake = medallion.Lake(f"{root}/lake")
    medallion.bronze_job(spark, landing, lake, "b1")            # bronze sites for the enrichment
    v = medallion.incremental_silver_job(spark, landing, lake)
    again = medallion.incremental_silver_job(spark, landing, lake)  # nothing new: no version
    assert again == v
    inc = read_layer(spark, lake.table("silver", "production"))
    batch = medallion.silver_frame(spark, lake)
    cols = ["timestamp", "site_id", "technology", "production_kwh", "status", "capacity_factor_pct"]
    assert sorted(map(tuple, inc.select(*cols).collect()), key=str) == \
        sorted(map(tuple, batch.select(*cols).collect()), key=str)


def test_incremental_gold_recomputes_only_touched_dates(spark):
    import datetime as dt

    from kilowatt.plans import medallion
    from kilowatt.plans.queries import _landing_layout
    root = scratch_path(spark, "t-incr-gold")
    lake = medallion.Lake(f"{root}/lake")
    medallion.bronze_job(spark, _landing_layout(spark, SF_TINY, root), lake, "b1")
    medallion.silver_job(spark, lake)
    medallion.gold_job(spark, lake)
    silver_path, daily_path = lake.table("silver", "production"), lake.table("gold", "daily_kpis")
    before = versioned.latest_version(spark, silver_path)
    day = dt.date(2024, 1, 10)
    corr = read_layer(spark, silver_path).filter(F.col("date") == F.lit(day)) \
        .withColumn("production_kwh", F.col("production_kwh") + 10)
    versioned.merge_into(silver_path, corr, recent_days=None)
    touched = medallion.touched_since(spark, silver_path, before)
    assert touched == ["2024-01-10"]
    full_before = {(r["date"], r["site_id"], r["technology"]): r["total_production_kwh"]
                   for r in read_layer(spark, daily_path).collect()}
    medallion.gold_job(spark, lake, dates=touched)
    assert versioned.commits(spark, daily_path).orderBy(F.col("version").desc()).first()["touched"] == ["2024-01-10"]
    # nothing new since then: nothing to rebuild
    assert medallion.touched_since(spark, silver_path, versioned.latest_version(spark, silver_path)) == []
    inc = {(r["date"], r["site_id"], r["technology"]): r["total_production_kwh"]
           for r in read_layer(spark, daily_path).collect()}
    from kilowatt.operators import gold
    fresh = {(r["date"], r["site_id"], r["technology"]): r["total_production_kwh"]
             for r in gold.daily_kpis(read_layer(spark, silver_path)).collect()}
    assert inc == fresh
    assert any(inc[k] != full_before[k] for k in inc if k[0] == day)
    assert all(inc[k] == full_before[k] for k in inc if k[0] != day)
