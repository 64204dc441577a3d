import datetime as dt


from kilowatt import schemas
from kilowatt.session import scratch_path
from kilowatt.sinks.layers import write_csv
from kilowatt.sources.files import file_inventory, read_csv
from kilowatt.streaming import ingest, rollup

T = dt.datetime(2024, 1, 1, 10)
SOLAR = "timestamp timestamp, site_id string, panel_temp_c double, irradiance_w_m2 double, " \
        "production_kwh double, status string"


def test_incremental_ingest_exactly_once(spark):
    root = scratch_path(spark, "t-stream")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/_ck"
    a = spark.createDataFrame([(T, "S1", 1.0, 2.0, 3.0, "OK")], SOLAR)
    b = spark.createDataFrame([(T + dt.timedelta(hours=1), "S1", 1.0, 2.0, 4.0, "OK")], SOLAR)
    write_csv(a, landing, mode="append")
    ingest.ingest_stream(spark, landing, schemas.SOLAR_SCHEMA, out, ck)
    assert spark.read.parquet(out).count() == 1
    ingest.ingest_stream(spark, landing, schemas.SOLAR_SCHEMA, out, ck)  # nothing new
    assert spark.read.parquet(out).count() == 1
    write_csv(b, landing, mode="append")
    ingest.ingest_stream(spark, landing, schemas.SOLAR_SCHEMA, out, ck)
    got = spark.read.parquet(out)
    assert got.count() == 2
    assert {"_ingested_at", "_source_file", "_year", "_month"} <= set(got.columns)
    # stream result equals the batch read of the same files
    batch = read_csv(spark, landing, schema=schemas.SOLAR_SCHEMA)
    cols = [f.name for f in schemas.SOLAR_SCHEMA.fields]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.collect()))


def test_glob_keeps_foreign_files_out(spark):
    root = scratch_path(spark, "t-glob")
    write_csv(spark.createDataFrame([(T, "S1", 1.0, 2.0, 3.0, "OK")], SOLAR), f"{root}/solar")
    write_csv(spark.createDataFrame([("S9", "name", "r", "1")], "a string, b string, c string, d string"),
              f"{root}/sites")
    inv = file_inventory(spark, root, glob="*.csv").collect()
    assert all(r["name"].endswith(".csv") for r in inv)
    assert {r["path"].split("/")[-2] for r in inv} == {"solar", "sites"}
    solar_only = read_csv(spark, f"{root}/solar", schema=schemas.SOLAR_SCHEMA, glob="*.csv")
    assert solar_only.count() == 1


def test_windowed_rollup_closed_windows_only(spark):
    root = scratch_path(spark, "t-roll")
    rows = [(T + dt.timedelta(minutes=20 * i), "S1", "solar", 1.0) for i in range(10)]
    src = spark.createDataFrame(rows, "timestamp timestamp, site_id string, technology string, production_kwh double")
    src.write.parquet(f"{root}/in")
    s = spark.readStream.schema(src.schema).parquet(f"{root}/in")
    q = rollup.windowed_rollup(s, "1 hour", "10 minutes")
    ingest.run_incremental(q, f"{root}/out", f"{root}/_ck")
    got = spark.read.parquet(f"{root}/out").orderBy("window_start").collect()
    # events 10:00–13:00; the watermark ends at 12:50, so the 12:00 and 13:00
    # windows are still open
    assert [r["n_readings"] for r in got] == [3, 3]


def test_drift_alerts_label(spark):
    base = spark.createDataFrame([("S1", 1.0, 0.1, 30)], "site_id string, baseline_mean double, "
                                                         "baseline_std double, baseline_days long")
    d = spark.createDataFrame([(dt.date(2024, 1, 2), "S1", 0.7), (dt.date(2024, 1, 3), "S1", 1.05)],
                              "date date, site_id string, production_mwh double")
    out = {r["date"].day: r for r in rollup.drift_alerts(d, base).collect()}
    assert out[2]["z_score"] == -3.0 and out[2]["alert_level"].endswith("ANOMALIE BASSE")
    assert out[3]["alert_level"].endswith("Normal")


def _silver(batch):
    from kilowatt.operators import silver
    return silver.silver_technology(batch, silver.SOLAR)


def test_micro_batch_merge_is_replay_safe(spark):
    from kilowatt.sinks import versioned
    from kilowatt.streaming.upsert import merge_micro_batch
    path = scratch_path(spark, "t-upsert")
    b0 = spark.createDataFrame([(T, "S1", 1.0, 2.0, 3.0, "OK"), (T, "S1", 1.0, 2.0, 5.0, "OK")], SOLAR)
    b1 = spark.createDataFrame([(T, "S1", 1.0, 2.0, 7.0, "OK"),
                                (T + dt.timedelta(days=1), "S2", 1.0, 2.0, 1.0, "OK")], SOLAR)
    assert merge_micro_batch(b0, 0, path, _silver, "a") == 0
    assert merge_micro_batch(b1, 1, path, _silver, "a") == 1
    assert merge_micro_batch(b1, 1, path, _silver, "a") is None          # replayed batch: skipped
    got = {(r["site_id"], r["production_kwh"]) for r in versioned.read_version(spark, path).collect()}
    assert got == {("S1", 7.0), ("S2", 1.0)}
    # another stream's batch of the same number is no replay
    b2 = spark.createDataFrame([(T, "S3", 1.0, 2.0, 1.0, "OK")], SOLAR)
    assert merge_micro_batch(b2, 1, path, _silver, "b") == 2
    assert versioned.read_version(spark, path).count() == 3


def test_batches_end_where_one_batch_does(spark):
    from itertools import permutations

    from kilowatt.sinks import versioned
    from kilowatt.streaming.upsert import merge_micro_batch
    rows = [(T, "S1", 1.0, 2.0, v, s) for v, s in ((5.0, "OK"), (3.0, "OK"), (None, "OK"), (5.0, "DEGRADED"))]
    rows += [(None, "S1", 1.0, 2.0, 1.0, "OK")]  # no time, hence no date
    want = sorted(map(str, map(tuple, _silver(spark.createDataFrame(rows, SOLAR)).collect())))
    for order in list(permutations(rows))[::31]:
        path = scratch_path(spark, "t-order")
        for n, row in enumerate(order):
            merge_micro_batch(spark.createDataFrame([row], SOLAR), n, path, _silver, "a")
        got = versioned.read_version(spark, path)
        assert sorted(map(str, map(tuple, got.select(*_silver(spark.createDataFrame(rows, SOLAR)).columns).collect()))) == want


def test_site_without_baseline_keeps_its_row(spark):
    base = spark.createDataFrame([("S1", 1.0, 0.1, 30)], "site_id string, baseline_mean double, baseline_std double, baseline_days long")
    d = spark.createDataFrame([(dt.date(2024, 1, 2), "S9", 0.7)], "date date, site_id string, production_mwh double")
    row = rollup.drift_alerts(d, base).first()
    assert row["z_score"] is None and row["alert_level"] == "no baseline"


def test_csv_reads_both_timestamp_spellings(spark):
    root = scratch_path(spark, "t-ts")
    lines = ["timestamp,site_id,panel_temp_c,irradiance_w_m2,production_kwh,status",
             "2024-01-01 10:00:00,S1,1.0,2.0,3.0,OK",
             "2024-01-01T11:00:00.123456,S1,1.0,2.0,4.0,OK"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(root)
    got = read_csv(spark, root, schema=schemas.SOLAR_SCHEMA, glob="*.txt").orderBy("production_kwh").collect()
    assert [r["timestamp"] for r in got] == [T, dt.datetime(2024, 1, 1, 11, 0, 0, 123456)]


def test_stream_quality_observed_per_batch(spark):
    root = scratch_path(spark, "t-sq")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/_ck"
    a = spark.createDataFrame([(T, "S1", 1.0, 2.0, -3.0, "OK"), (T, "S2", 1.0, 2.0, None, "OFFLINE")], SOLAR)
    write_csv(a.coalesce(1), landing, mode="append")
    m = ingest.ingest_stream(spark, landing, schemas.SOLAR_SCHEMA, out, ck)
    assert m == {"total_rows": 2, "null_production": 1, "negative_production": 1, "offline_records": 1}
