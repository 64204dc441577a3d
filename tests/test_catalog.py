import datetime as dt
import uuid

import pytest

from kilowatt.session import path_exists, scratch_path
from kilowatt.sinks import catalog as C

D = [dt.date(2024, 1, n) for n in range(1, 10)]


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 't-db')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def frame(spark, rows, schema="k long, v double, date date"):
    return spark.createDataFrame(rows, schema)


def snap(spark, name):
    return sorted(map(str, map(tuple, spark.table(name).select("k", "v", "date").collect())))


@pytest.mark.parametrize("external", [False, True])
def test_comment_properties_and_replacement(spark, db, external):
    where = scratch_path(spark, "t-ext") if external else None
    t = f"{db}.gold"
    C.create_or_replace_table(frame(spark, [(1, 1.0, D[1])]), t, ["date"], "It's the \\ first", {"quality": "gold", "o'key": "a'b"}, {"v": "kWh"}, location=where)
    d = C.table_details(spark, t)
    assert (d["comment"], d["partition_by"], d["column_comments"]) == ("It's the \\ first", ["date"], {"v": "kWh"})
    assert d["properties"]["quality"] == "gold" and d["properties"]["o'key"] == "a'b"
    old = C._folder(spark, t)
    C.create_or_replace_table(spark.range(5), t, comment="second", properties={"quality": "silver"}, location=where)
    d = C.table_details(spark, t)
    assert (d["comment"], d["columns"], d["partition_by"], d["properties"]["quality"]) == ("second", ["id"], [], "silver")
    assert "o'key" not in d["properties"] and spark.table(t).count() == 5
    assert not path_exists(spark, old)
    now = C._folder(spark, t)
    assert path_exists(spark, now) and (not external or where in now)
    C.drop_table(spark, t)
    assert not path_exists(spark, now) and not spark.catalog.tableExists(t)


def test_a_failed_replacement_leaves_the_table(spark, db):
    t = f"{db}.keep"
    C.create_or_replace_table(spark.range(3), t, comment="old")
    with pytest.raises(Exception):
        C.create_or_replace_table(spark.range(9).selectExpr("id", "raise_error('lost') AS x"), t, comment="new")
    assert spark.table(t).count() == 3 and C.table_details(spark, t)["comment"] == "old"
    assert [x.name for x in spark.catalog.listTables(db)] == ["keep"]


def test_append_evolves_and_overwrite_is_by_partition(spark, db):
    t = f"{db}.parts"
    C.create_or_replace_table(frame(spark, [(1, 1.0, D[1]), (2, 2.0, D[2])]), t, ["date"])
    C.append_table(spark.createDataFrame([(D[3], 3, "x")], "date date, k long, extra string"), t)
    rows = {r["k"]: r for r in spark.table(t).collect()}
    assert rows[3]["extra"] == "x" and rows[3]["v"] is None and rows[1]["extra"] is None
    C.overwrite_partitions(frame(spark, [(9, 9.0, D[2])]), t)
    assert snap(spark, t) == sorted(map(str, [(1, 1.0, D[1]), (9, 9.0, D[2]), (3, None, D[3])]))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_into_a_table(spark, db):
    t = f"{db}.merged"
    C.create_or_replace_table(frame(spark, [(1, 1.0, D[1]), (2, 2.0, D[2]), (3, 3.0, D[3]), (4, 4.0, None)]), t, ["date"])
    untouched = {f for f in spark.table(t).inputFiles() if "date=2024-01-02" in f}
    C.merge_table(t, frame(spark, [(3, 8.0, D[3]), (4, 5.0, None), (7, 7.0, D[7])]), ["k"], ["v"], as_of=D[4], recent_days=2)
    assert snap(spark, t) == sorted(map(str, [(1, 1.0, D[1]), (3, 8.0, D[3]), (4, 5.0, None), (7, 7.0, D[7])]))
    assert untouched <= set(spark.table(t).inputFiles())
    shown = {r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()}
    assert "date=2024-01-03" not in shown and len(shown) == 4


def test_a_bucketed_target_is_joined_where_it_lies(spark, db):
    from kilowatt.operators.merge import merge_upsert
    t = f"{db}.bucketed"
    target = frame(spark, [(k, float(k), D[k % 9]) for k in range(500)])
    C.create_or_replace_table(target, t, buckets=(5, ["k"]))
    source = frame(spark, [(k, k + (k % 7 == 0), D[k % 9]) for k in range(250, 900)], "k long, v long, date date").selectExpr("k", "double(v) AS v", "date")
    plan = C.bucketed_merge(t, source, ["k"], compare=["v"], recent_days=None)
    want = merge_upsert(target, source, ["k"], ["v"], recent_days=None)
    assert sorted(map(str, plan.collect())) == sorted(map(str, want.collect()))
    shown = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # what is shuffled is the source, into the table's five parts
    exchanges = shown.split("Exchange ")[1:]
    assert len(exchanges) == 1 and all(", 5), REPARTITION_BY_NUM" in e.split("\n")[0] for e in exchanges)
    assert all("ExistingRDD" in e.split("FileScan")[0] for e in exchanges) and "Bucketed: true" in shown
    with pytest.raises(ValueError, match="not bucketed"):
        C.bucketed_merge(t, source, ["v"])


def test_inventory_and_streams(spark, db):
    t = f"{db}.stream"
    src = scratch_path(spark, "t-src")
    spark.range(10).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    checkpoint = scratch_path(spark, "t-ck")
    C.stream_to_table(stream, t, checkpoint)
    spark.range(10, 15).write.mode("append").parquet(src)
    C.stream_to_table(spark.readStream.schema("id long").parquet(src), t, checkpoint)
    C.create_or_replace_table(spark.range(3).selectExpr("id", "id AS x"), f"{db}.other", comment="three")
    found = {r["table_name"]: r for r in C.catalog_inventory(spark, db).collect()}
    assert (found["stream"]["num_rows"], found["other"]["num_rows"], found["other"]["num_columns"], found["other"]["comment"]) == (15, 3, 2, "three")
