import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilowatt.session import list_folder, path_exists, scratch_path
from kilowatt.sinks import partitioned as P

SCHEMA = "k long, v double, date date"
D = [dt.date(2024, 1, n) for n in range(1, 10)]


def table(spark, rows):
    path = scratch_path(spark, "t-parts")
    P.write_partitions(spark.createDataFrame(rows, SCHEMA), path)
    return path


def rows_of(spark, path):
    like = spark.createDataFrame([], SCHEMA).schema
    return sorted((tuple(r) for r in P.read_partitions(spark, path, like).select("k", "v", "date").collect()), key=str)


def files_of(spark, path):
    return {f.split(path.rsplit("/", 1)[1])[1] for f in spark.read.parquet(path).inputFiles()}


def merge(spark, path, rows, **more):
    return P.merge_partitions(path, spark.createDataFrame(rows, SCHEMA), ["k"], ["v"], **{"recent_days": None, **more})


def test_untouched_partitions_keep_their_files(spark):
    path = table(spark, [(n, float(n), D[n]) for n in range(5)])
    before = files_of(spark, path)
    counts = merge(spark, path, [(1, 9.0, D[1]), (7, 7.0, D[7])])
    assert counts == {"insert": 1, "update": 1, "delete": 0, "keep": 0}
    after = files_of(spark, path)
    assert {f for f in before if "date=2024-01-02" not in f} <= after
    assert not {f for f in before if "date=2024-01-02" in f} & after
    assert rows_of(spark, path) == [(0, 0.0, D[0]), (1, 9.0, D[1]), (2, 2.0, D[2]), (3, 3.0, D[3]), (4, 4.0, D[4]), (7, 7.0, D[7])]
    assert not list_folder(spark, f"{path}/_pending")


def test_a_partition_without_rows_goes(spark):
    path = table(spark, [(1, 1.0, D[1]), (2, 2.0, D[2]), (3, 3.0, D[3])])
    counts = merge(spark, path, [(3, 3.0, D[3])], as_of=D[4], recent_days=2)
    assert counts == {"insert": 0, "update": 0, "delete": 1, "keep": 1}
    assert rows_of(spark, path) == [(1, 1.0, D[1]), (3, 3.0, D[3])]
    assert not path_exists(spark, f"{path}/date=2024-01-03")
    counts = merge(spark, path, [(9, 1.0, D[8])], as_of=D[8], recent_days=30)
    assert rows_of(spark, path) == [(9, 1.0, D[8])] and counts["delete"] == 2


def test_null_dates_and_keys(spark):
    path = table(spark, [(1, 1.0, None), (None, 2.0, D[2]), (3, 3.0, D[3])])
    before = files_of(spark, path)
    merge(spark, path, [(1, 5.0, None), (None, 4.0, D[2])])
    assert rows_of(spark, path) == sorted([(1, 5.0, None), (None, 2.0, D[2]), (None, 4.0, D[2]), (3, 3.0, D[3])], key=str)
    assert len(before & files_of(spark, path)) == 1
    only_null = table(spark, [(1, 1.0, None)])
    merge(spark, only_null, [(1, 2.0, None)])
    assert rows_of(spark, only_null) == [(1, 2.0, None)]


def test_a_failed_stage_leaves_the_table_whole(spark):
    path = table(spark, [(1, 1.0, D[1]), (2, 2.0, D[2])])
    before = files_of(spark, path)
    with pytest.raises(Exception, match="duplicate keys"):
        merge(spark, path, [(1, 5.0, D[1]), (1, 6.0, D[1])])
    assert files_of(spark, path) == before and rows_of(spark, path) == [(1, 1.0, D[1]), (2, 2.0, D[2])]
    merge(spark, path, [(1, 5.0, D[1])])  # the next write clears the failed one away
    assert rows_of(spark, path) == [(1, 5.0, D[1]), (2, 2.0, D[2])] and not list_folder(spark, f"{path}/_pending")


def test_a_job_lost_while_putting_in_place_is_finished(spark, monkeypatch):
    path = table(spark, [(1, 1.0, D[1]), (2, 2.0, D[2]), (3, 3.0, D[3])])
    done = P._put_in_place

    def lost(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(P, "_put_in_place", lost)
    with pytest.raises(RuntimeError):
        merge(spark, path, [(3, 9.0, D[3])], as_of=D[4], recent_days=2)
    assert rows_of(spark, path) == [(1, 1.0, D[1]), (2, 2.0, D[2]), (3, 3.0, D[3])]
    monkeypatch.setattr(P, "_put_in_place", done)
    assert P.finish_pending(spark, path) == 1 and P.finish_pending(spark, path) == 0
    assert rows_of(spark, path) == [(1, 1.0, D[1]), (3, 9.0, D[3])]


def test_first_write_and_empty_batches(spark):
    path = scratch_path(spark, "t-parts")
    assert P.upsert_best(path, spark.createDataFrame([], SCHEMA), ["k"], "v") == []
    assert P.upsert_best(path, spark.createDataFrame([(1, 1.0, D[1]), (1, 3.0, D[1])], SCHEMA), ["k"], "v") == [D[1]]
    assert P.upsert_best(path, spark.createDataFrame([(1, 2.0, D[1]), (2, None, None)], SCHEMA), ["k"], "v") == [D[1], None]
    want = sorted([(1, 3.0, D[1]), (2, None, None)], key=str)
    assert rows_of(spark, path) == want
    P.upsert_best(path, spark.createDataFrame([(1, 2.0, D[1]), (2, None, None)], SCHEMA), ["k"], "v")  # a replayed batch
    assert rows_of(spark, path) == want


def test_only_touched_partitions_are_read(spark):
    path = table(spark, [(n, float(n), D[n % 9]) for n in range(90)])
    like = spark.createDataFrame([], SCHEMA).schema
    hit = P.read_partitions(spark, path, like).filter(P.in_values("date", [D[1], None]))
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_live_silver_equals_batch_silver(spark):
    from kilowatt.operators import gold
    from kilowatt.plans import medallion
    from kilowatt.plans.queries import _landing_layout
    from kilowatt.sinks import versioned
    from tests.conftest import SF_TINY
    root = scratch_path(spark, "t-live")
    lake = medallion.Lake(f"{root}/lake")
    landing = _landing_layout(spark, SF_TINY, root)
    medallion.bronze_job(spark, landing, lake, "b1")
    medallion.silver_job(spark, lake)
    touched = medallion.live_silver_job(spark, landing, lake)
    assert touched and medallion.live_silver_job(spark, landing, lake) == []
    live = spark.read.parquet(lake.table("silver", medallion.LIVE))
    cols = ["timestamp", "site_id", "technology", "production_kwh", "status", "capacity_factor_pct"]
    snap = lambda df: sorted(map(tuple, df.select(*cols).collect()), key=str)
    assert snap(live) == snap(versioned.read_version(spark, lake.table("silver", "production")))
    medallion.gold_job(spark, lake, dates=touched, source=medallion.LIVE)
    days = versioned.read_version(spark, lake.table("gold", "daily_kpis"))
    assert days.count() == gold.daily_kpis(live).count() == days.filter(F.col("total_hours") > 0).count()


def test_live_gold_follows_new_files(spark, monkeypatch):
    """Silver and gold in place over two arrivals; a gold job lost midway is done again."""
    import json

    from kilowatt.__main__ import main
    from kilowatt.operators import gold
    from kilowatt.plans import medallion
    from kilowatt.plans.queries import _landing_layout
    from tests.conftest import SF_TINY
    root = scratch_path(spark, "t-live-gold")
    lake = medallion.Lake(f"{root}/lake")
    landing = _landing_layout(spark, SF_TINY, root)
    medallion.bronze_job(spark, landing, lake, "b1")
    assert main(["incremental", "--landing", landing, "--lake", lake.root]) == 0

    def snap(df):
        return sorted(str(sorted(r.asDict().items())) for r in df.collect())

    def equal():
        daily = gold.daily_kpis(spark.read.parquet(lake.table("silver", medallion.LIVE)))
        got = {k: spark.read.parquet(lake.table("gold", t)) for k, t in medallion.LIVE_GOLD.items()}
        report = gold.site_efficiency_report(daily)
        assert snap(got["daily"].select(*daily.columns)) == snap(daily)
        assert snap(got["enriched"].select(*gold.enrich_daily(daily).columns)) == snap(gold.enrich_daily(daily))
        assert snap(got["report"].withColumn("month_label", F.col("month_label").cast("string")).select(*report.columns)) == snap(report)

    equal()
    untouched = {f for f in spark.read.parquet(lake.table("gold", "daily_kpis_live")).inputFiles() if "date=2024-01-20" in f}
    lines = ["timestamp,site_id,panel_temp_c,irradiance_w_m2,production_kwh,status"] + [
        f"2024-01-{d:02d}T1{h}:00:00.000000,{s},20.0,500.0,{900 + s + h}.5,OK" for d in (5, 12) for h in range(3) for s in range(0, 40, 2)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/more")
    part = next(f for f in list_folder(spark, f"{root}/more") if f.endswith(".txt"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(f"{landing}/solar_more.csv")
    source.getFileSystem(conf).rename(source, target)
    assert medallion.live_silver_job(spark, landing, lake) == [dt.date(2024, 1, 5), dt.date(2024, 1, 12)]
    from kilowatt.operators import incremental
    real = incremental.report_state
    monkeypatch.setattr(incremental, "report_state", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        medallion.live_gold_job(spark, lake)
    monkeypatch.setattr(incremental, "report_state", real)
    assert medallion.live_silver_job(spark, landing, lake) == []  # the stream has nothing new, the notes have
    assert medallion.live_gold_job(spark, lake) == [dt.date(2024, 1, 5), dt.date(2024, 1, 12)]
    equal()
    assert untouched <= set(spark.read.parquet(lake.table("gold", "daily_kpis_live")).inputFiles())
    assert medallion.live_gold_job(spark, lake) == [] and json
