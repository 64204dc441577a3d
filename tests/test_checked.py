import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from kilowatt.session import scratch_path
from kilowatt.sources import checked
from kilowatt.streaming import evolve, ingest

TS, SITE, KWH = StructField("timestamp", TimestampType()), StructField("site_id", StringType()), StructField("production_kwh", DoubleType())
RPM = StructField("rpm", IntegerType())
SCHEMA = StructType([TS, SITE, KWH, RPM, StructField("status", StringType())])
LINES = ["2024-01-01 10:00:00,S1,3.5,7,OK", "2024-01-01 11:00:00,S1,n/a,7,OK", "noon,S1,1.0,7,OK", "2024-01-01 12:00:00,S1,1.0,7",
         "2024-01-01 13:00:00,S1,1.0,7,OK,extra", "2024-01-01 14:00:00,,1.0,7,OK", "2024-01-01 15:00:00,S2,,,", "2024-01-01 16:00:00,S2,1.0,7.5,OK",
         '2024-01-01 17:00:00,"S,3",2.0,7,OK', '2024-01-01 18:00:00,"S,3",x,7,OK', "", "2024-01-01 19:00:00,S4,1e400,7,OK"]
WANT = {"11": "production_kwh: not a double", "noon": "timestamp: not a timestamp", "12": "fields: 4 of 5", "13": "fields: 6 of 5",
        "14": "site_id: missing", "16": "rpm: not a int", "18": "production_kwh: not a double"}


def land(spark, lines, folder=None, header=True):
    folder = folder or scratch_path(spark, "t-checked")
    rows = ([",".join(SCHEMA.names)] if header else []) + lines
    spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1).write.mode("append").text(folder)
    return folder


def check(spark, target):
    good, bad = checked.accepted(spark, target, SCHEMA), checked.rejected(spark, target, SCHEMA)
    assert good.count() + bad.count() == len([x for x in LINES if x])  # blank lines are no records
    assert sorted(r["timestamp"].hour for r in good.collect()) == [10, 15, 17, 19]
    assert {r["site_id"] for r in good.collect()} == {"S1", "S2", "S,3", "S4"}
    for r in bad.collect():
        raw = r[checked.RAW]
        key = raw.split(",")[0][11:13] or "noon" if raw else str(r["timestamp"].hour)
        assert r[checked.REASON] == WANT["noon" if raw and raw.startswith("noon") else key]
        assert raw in LINES or (raw is None and key == "14")
    assert {r[checked.REASON] for r in bad.collect()} == set(WANT.values())


def test_batch_and_stream_keep_bad_records_aside(spark):
    folder = land(spark, LINES)
    batch, stream = scratch_path(spark, "t-b"), scratch_path(spark, "t-s")
    checked.write_checked(checked.read_checked(spark, folder, SCHEMA, ["timestamp", "site_id"]), batch)
    check(spark, batch)
    rows = checked.stream_checked(spark, folder, SCHEMA, ["timestamp", "site_id"], glob="*.txt")
    ingest.run_incremental(rows, stream, scratch_path(spark, "t-ck"), partition_by=[checked.REJECTED])
    check(spark, stream)


def test_a_column_selected_alone_is_judged_by_the_whole_record(spark):
    rows = checked.read_checked(spark, land(spark, LINES), SCHEMA)
    sites = rows.select("site_id", checked.REASON).collect()
    assert sum(r[checked.REASON] is None for r in sites) == 5  # the one without a site fits the schema
    assert sum(r[checked.REASON] is not None for r in sites) == 6


def test_files_without_bad_or_without_good_records(spark):
    for lines, good, bad in (([LINES[0]], 1, 0), ([LINES[1]], 0, 1)):
        target = scratch_path(spark, "t-one")
        checked.write_checked(checked.read_checked(spark, land(spark, lines), SCHEMA), target)
        assert (checked.accepted(spark, target, SCHEMA).count(), checked.rejected(spark, target, SCHEMA).count()) == (good, bad)


# -- files whose columns change ----------------------------------------------

DECLARED = StructType([TS, SITE, KWH])


def drop(spark, folder, header, *rows):
    spark.createDataFrame([(x,) for x in (header, *rows)], "value string").coalesce(1).write.mode("append").text(folder)


def run(spark, root, **more):
    return evolve.ingest_changing(spark, f"{root}/in", DECLARED, f"{root}/out", f"{root}/ck", glob="*.txt", required=["site_id"], **more)


def found(spark, root):
    rows = evolve.read_changing(spark, f"{root}/out", f"{root}/ck").collect()
    return sorted(rows, key=lambda r: (str(r["timestamp"]), str(r["production_kwh"])))


def test_columns_come_go_and_move(spark):
    root = scratch_path(spark, "t-evolve")
    drop(spark, f"{root}/in", "timestamp,site_id,production_kwh", "2024-01-01 10:00:00,S1,1.5")
    assert run(spark, root) == DECLARED
    drop(spark, f"{root}/in", "production_kwh,firmware,site_id,timestamp", "2.5,v1,S1,2024-01-01 11:00:00", "oops,v1,S1,2024-01-01 12:00:00")
    drop(spark, f"{root}/in", "timestamp,site_id", "2024-01-01 13:00:00,S2")
    drop(spark, f"{root}/in", "timestamp,production_kwh", "2024-01-01 14:00:00,3.5")
    assert run(spark, root).names == [*DECLARED.names, "firmware"]
    run(spark, root)  # nothing new
    rows = found(spark, root)
    assert [r["timestamp"].hour for r in rows] == [10, 11, 12, 13, 14]
    assert [r["production_kwh"] for r in rows] == [1.5, 2.5, None, None, 3.5]
    assert [r["firmware"] for r in rows] == [None, "v1", "v1", None, None]
    assert [r["_reject_reason"] for r in rows] == [None, None, "production_kwh: not a double", None, "site_id: missing"]
    assert rows[2]["_raw_record"] == "oops,v1,S1,2024-01-01 12:00:00" and all(r["_source_file"].endswith(".txt") for r in rows)


def test_a_replayed_batch_counts_once(spark, monkeypatch):
    root = scratch_path(spark, "t-replay")
    drop(spark, f"{root}/in", "timestamp,site_id,production_kwh", "2024-01-01 10:00:00,S1,1.5")
    real = evolve._read

    def lost(*a):
        monkeypatch.setattr(evolve, "_read", real)
        real(*a).withColumn("_batch", F.lit(0)).write.mode("append").partitionBy("_batch", "_rejected").parquet(f"{root}/out")
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(evolve, "_read", lost)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, root)
    run(spark, root)
    assert len(found(spark, root)) == 1


def test_a_changed_type_stops_the_job(spark):
    root = scratch_path(spark, "t-type")
    drop(spark, f"{root}/in", "timestamp,site_id,production_kwh", "2024-01-01 10:00:00,S1,1.5")
    run(spark, root)
    other = StructType([TS, SITE, StructField("production_kwh", StringType())])
    with pytest.raises(evolve.SchemaChanged, match="production_kwh: double is stored, string declared"):
        evolve.ingest_changing(spark, f"{root}/in", other, f"{root}/out", f"{root}/ck", glob="*.txt")
    more = StructType([TS, SITE, KWH, RPM])
    assert evolve.ingest_changing(spark, f"{root}/in", more, f"{root}/out", f"{root}/ck", glob="*.txt").names == more.names
    assert len(found(spark, root)) == 1


def test_headers_of_many_files_and_of_none(spark):
    root = scratch_path(spark, "t-heads")
    for i in range(7):
        drop(spark, f"{root}/in", f"a,b{i % 3}", *[f"{k},x" for k in range(50)])
    spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    files = [f for f in spark.read.text(f"{root}/in").inputFiles()]
    heads = evolve.headers(spark, files)
    assert len(heads) == 7 and set(heads.values()) == {("a", "b0"), ("a", "b1"), ("a", "b2")}
    drop(spark, f"{root}/twice", "a,a", "1,2")
    with pytest.raises(evolve.SchemaChanged, match="occurs twice"):
        evolve.headers(spark, spark.read.text(f"{root}/twice").inputFiles())


def test_before_the_first_file(spark):
    root = scratch_path(spark, "t-none")
    land(spark, [], f"{root}/in", header=False)
    assert run(spark, root) == DECLARED and found(spark, root) == []
    assert dt.datetime  # the schema alone is known
