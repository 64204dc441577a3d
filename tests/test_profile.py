import datetime as dt

from pyspark.sql import functions as F

from kilowatt import schemas
from kilowatt.operators import bronze
from kilowatt.session import scratch_path
from kilowatt.sinks.layers import write_csv
from kilowatt.streaming import ingest, profile

T = dt.datetime(2024, 1, 1, 10)
SOLAR = "timestamp timestamp, site_id string, panel_temp_c double, irradiance_w_m2 double, production_kwh double, status string"


def drop(spark, landing, rows):
    write_csv(spark.createDataFrame([(T + dt.timedelta(hours=h), s, 1.0, 2.0, p, st) for h, s, p, st in rows], SOLAR).coalesce(2), landing, mode="append")


def run(spark, root, **more):
    return profile.ingest_profiled(spark, f"{root}/in", schemas.SOLAR_SCHEMA, f"{root}/out", f"{root}/ck", f"{root}/state", **more).first()


def test_profile_equals_the_batch_profile(spark):
    root = scratch_path(spark, "t-profile")
    drop(spark, f"{root}/in", [(0, "S1", 1.0, "OK"), (1, "S2", -1.0, "OFFLINE"), (2, "S1", None, "OK")])
    run(spark, root)
    drop(spark, f"{root}/in", [(-5, "S2", 1.0, "OK"), (9, "S3", None, "OFFLINE"), (3, None, 1.0, None)])
    drop(spark, f"{root}/in", [(4, f"N{i}", 1.0, "OK") for i in range(300)])
    got = run(spark, root, max_files_per_trigger=1)
    assert run(spark, root) == got  # nothing new
    want = bronze.quality_profile({"x": spark.read.parquet(f"{root}/out")}).first()
    for c in profile.FIGURES:
        assert got[c] == want[c], c
    assert got["distinct_sites"] == 303 and got["total_rows"] == 306


def test_a_batch_done_twice_counts_once(spark):
    state = scratch_path(spark, "t-state")
    rows = spark.createDataFrame([(T, f"S{i % 5}", 1.0, 2.0, 1.0, "OK") for i in range(20)], SOLAR)
    for _ in range(2):
        profile.profile_batch(rows, state, "a-0")
    profile.profile_batch(rows.withColumn("site_id", F.concat("site_id", F.lit("x"))), state, "a-1")
    for _ in range(2):
        profile.profile_batch(rows, state, "a-0")  # its sites keep their numbers
    r = profile.profile(spark, state).first()
    assert (r["total_rows"], r["distinct_sites"]) == (40, 10)
    numbers = spark.read.parquet(f"{state}/sites")
    assert numbers.count() == numbers.select("number").distinct().count() == 10


def test_bitmaps_beyond_one_bucket(spark):
    state = scratch_path(spark, "t-state")
    many = spark.range(70_000).select(F.lit(T).alias("timestamp"), F.concat(F.lit("S"), "id").alias("site_id"), F.lit(1.0).alias("production_kwh"), F.lit("OK").alias("status"))
    profile.profile_batch(many, state, "a-0")
    profile.profile_batch(many.filter("production_kwh > 2"), state, "a-1")
    assert profile.profile(spark, state).first()["distinct_sites"] == 70_000
    assert spark.read.parquet(f"{state}/bitmaps").count() == 3


def test_no_batch_yet(spark):
    r = profile.profile(spark, scratch_path(spark, "t-state")).first()
    assert (r["total_rows"], r["distinct_sites"], r["min_ts"]) == (0, 0, None)


def test_incomplete_counts_are_an_error(spark, monkeypatch):
    import pytest
    root = scratch_path(spark, "t-slow")
    drop(spark, f"{root}/in", [(0, "S1", 1.0, "OK")])

    monkeypatch.setattr(ingest._Totals, "onQueryTerminated", lambda self, event: None)
    monkeypatch.setattr(ingest, "LISTENER_WAIT_S", 0.2)
    with pytest.raises(TimeoutError, match="not complete"):
        ingest.ingest_stream(spark, f"{root}/in", schemas.SOLAR_SCHEMA, f"{root}/out", f"{root}/ck")
