import datetime as dt

from kilowatt.session import scratch_path
from kilowatt.streaming import dedup, drift, ingest

T = dt.datetime(2024, 1, 1, 10)
DAILY = "date date, site_id long, technology string, total_production_mwh double"


def drop(spark, root, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_repeats_across_batches_are_dropped_once(spark):
    root, schema = scratch_path(spark, "t-dedup"), "timestamp timestamp_ntz, site_id string, v long"
    at = lambda m: T + dt.timedelta(minutes=m)

    def run():
        s = dedup.drop_repeats(spark.readStream.schema(schema).parquet(f"{root}/in"), ["site_id", "timestamp"], "1 hour")
        ingest.run_incremental(s, f"{root}/out", f"{root}/ck")
        return sorted(((r["timestamp"].minute, r["site_id"]) for r in spark.read.schema(schema).parquet(f"{root}/out").collect()), key=str)

    drop(spark, root, [(at(0), "a", 1), (at(0), "a", 2), (at(10), "a", 1), (at(0), None, 1), (at(0), None, 2)], schema)
    assert run() == sorted([(0, "a"), (10, "a"), (0, None)], key=str)
    drop(spark, root, [(at(10), "a", 9), (at(20), "b", 1)], schema)
    assert run() == sorted([(0, "a"), (10, "a"), (0, None), (20, "b")], key=str)


def test_state_ends_with_the_watermark(spark):
    root, schema = scratch_path(spark, "t-dedup"), "timestamp timestamp, site_id string"
    q = None
    for day in range(3):
        drop(spark, root, [(T + dt.timedelta(days=day, minutes=m), f"s{m}") for m in range(50)], schema)
        s = dedup.drop_repeats(spark.readStream.schema(schema).parquet(f"{root}/in"), ["site_id", "timestamp"], "1 hour")
        q = ingest.run_incremental(s, f"{root}/out", f"{root}/ck")
    state = q.recentProgress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] <= 100  # a day's rows of three: those before the watermark are forgotten
    assert spark.read.parquet(f"{root}/out").count() == 150


def judge(spark, batches, **more):
    root = scratch_path(spark, "t-drift")
    for rows in batches:
        drop(spark, root, rows, DAILY)
        s = drift.learned_drift(spark.readStream.schema(DAILY).parquet(f"{root}/in"), **more)
        ingest.run_incremental(s, f"{root}/out", f"{root}/ck")
    return sorted(map(tuple, spark.read.parquet(f"{root}/out").collect()), key=lambda r: (r[1], r[0]))


def days(values, site=1, start=1):
    return [(dt.date(2024, 1, start + i), site, "wind", v) for i, v in enumerate(values)]


def test_batches_learn_as_one_batch_does(spark):
    rows = days([1.0, 2.0, None, 4.0, 4.5, 90.0, 3.0]) + days([5.0] * 7, site=2)
    whole = judge(spark, [rows])
    split = judge(spark, [[r for r in rows if r[0].day <= 3], [r for r in rows if 3 < r[0].day <= 5], [r for r in rows if r[0].day > 5]])
    assert whole == split
    site = [r for r in whole if r[1] == 1]
    assert [r[4] for r in site] == [0, 1, 2, 2, 3, 4, 5]
    assert site[2][6] is None and site[0][7] == site[1][7] == "no baseline" and site[5][6] > 2 and "exceptionnelle" in site[5][7]
    assert all(r[6] is None for r in whole if r[1] == 2)  # no deviation, no score


def test_a_silent_site_starts_anew(spark):
    got = judge(spark, [days([1.0, 2.0, 3.0]), days([50.0, 51.0, 52.0], start=20)], expiry_days=10)
    assert [r[4] for r in got] == [0, 1, 2, 0, 1, 2]
    got = judge(spark, [days([1.0, 2.0, 3.0]), days([50.0], start=13)], expiry_days=10)
    assert [r[4] for r in got] == [0, 1, 2, 3]
