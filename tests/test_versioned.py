import datetime as dt

from pyspark.sql import functions as F

from kilowatt.session import scratch_path
from kilowatt.sinks import versioned


def snap(df):
    return sorted(tuple(r) for r in df.select("k", "v", "date").collect())


def test_versions_merge_and_history(spark):
    path = scratch_path(spark, "test-versioned")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    v0 = spark.createDataFrame([(1, 1.0, d1), (2, 2.0, d2)], "k long, v double, date date")
    assert versioned.write_version(v0, path, partition_col="date") == 0
    src = spark.createDataFrame([(2, 5.0, d2), (3, 1.0, d2)], "k long, v double, date date")
    assert versioned.merge_into(path, src, ["k"], ["v"], recent_days=None) == 1
    assert snap(versioned.read_version(spark, path, 0)) == [(1, 1.0, d1), (2, 2.0, d2)]
    assert snap(versioned.read_version(spark, path)) == [(1, 1.0, d1), (2, 5.0, d2), (3, 1.0, d2)]
    # a later whole-table write does not change what version 0 or 1 read
    versioned.write_version(v0.filter("k = 1"), path, "WRITE", partition_col="date")
    assert snap(versioned.read_version(spark, path)) == [(1, 1.0, d1)]
    assert snap(versioned.read_version(spark, path, 1)) == [(1, 1.0, d1), (2, 5.0, d2), (3, 1.0, d2)]
    h = [r.asDict() for r in versioned.history(spark, path).collect()]
    assert [r["version"] for r in h] == [2, 1, 0]
    assert (h[1]["num_inserted"], h[1]["num_updated"], h[1]["num_deleted"], h[1]["num_kept"], h[1]["num_output_rows"]) == (1, 1, 0, 1, 3)


def test_null_partition_values_survive_a_merge(spark):
    path = scratch_path(spark, "test-versioned")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    versioned.write_version(spark.createDataFrame([(1, 1.0, d1), (2, 2.0, d2), (3, 3.0, None)], "k long, v double, date date"), path, partition_col="date")
    versioned.merge_into(path, spark.createDataFrame([(2, 9.0, d2), (4, 4.0, None)], "k long, v double, date date"), ["k"], ["v"], recent_days=None)
    got = versioned.read_version(spark, path).select("k", "v", "date").collect()
    assert sorted((r["k"], r["v"], str(r["date"])) for r in got) == [(1, 1.0, str(d1)), (2, 9.0, str(d2)), (3, 3.0, "None"), (4, 4.0, "None")]


def test_every_version_has_its_own_columns_and_types(spark):
    path = scratch_path(spark, "test-versioned")
    versioned.write_version(spark.createDataFrame([(1, "7")], "k long, v string"), path)
    versioned.write_version(spark.createDataFrame([(1, 7.5, "new")], "k long, v double, extra string"), path)
    assert versioned.read_version(spark, path, 0).dtypes == [("k", "bigint"), ("v", "string")]
    assert versioned.read_version(spark, path).dtypes == [("k", "bigint"), ("v", "double"), ("extra", "string")]
    assert versioned.read_version(spark, path).first()["extra"] == "new"


def test_version_read_opens_one_folder_and_prunes_partitions(spark):
    path = scratch_path(spark, "test-versioned")
    df = spark.range(10).withColumn("date", F.lit("2024-01-01").cast("date"))
    versioned.write_version(df, path, partition_col="date")
    versioned.write_version(df, path, partition_col="date")
    read = versioned.read_version(spark, path, 0)
    assert len({f.split("/data/")[1].split("/")[0] for f in read.inputFiles()}) == 1
    assert "PartitionFilters: [isnotnull" in read.filter("date = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()


def test_uncommitted_attempt_is_never_read(spark):
    path = scratch_path(spark, "test-versioned")
    d = dt.date(2024, 1, 1)
    v0 = spark.createDataFrame([(1, 1.0, d)], "k long, v double, date date")
    versioned.write_version(v0, path, partition_col="date")
    # an attempt of version 1 that wrote its data but died before committing
    v0.write.partitionBy("date").parquet(f"{path}/data/v00000001-dead")
    v1 = spark.createDataFrame([(2, 2.0, d)], "k long, v double, date date")
    assert versioned.write_version(v1, path, "WRITE", partition_col="date") == 1
    assert snap(versioned.read_version(spark, path)) == [(2, 2.0, d)]
    assert snap(versioned.read_version(spark, path, 0)) == [(1, 1.0, d)]


def test_enforced_write_failure_keeps_previous_version(spark):
    import pytest

    from kilowatt.operators import quality
    path = scratch_path(spark, "test-versioned")
    d = dt.date(2024, 1, 1)
    good = spark.createDataFrame([(1, 1.0, d)], "k long, v double, date date")
    versioned.write_version(good, path, partition_col="date")
    bad = spark.createDataFrame([(2, -5.0, d)], "k long, v double, date date")
    rules = {"chk_v_positive": F.col("v") >= 0}
    with pytest.raises(Exception, match="chk_v_positive"):
        versioned.write_version(quality.expect(bad, rules, "enforce"), path, partition_col="date")
    assert snap(versioned.read_version(spark, path)) == [(1, 1.0, d)]
    assert versioned.latest_version(spark, path) == 0


def test_a_version_that_does_not_exist_is_an_error(spark):
    import pytest
    path = scratch_path(spark, "test-versioned")
    versioned.write_version(spark.range(3), path)
    for version in (1, 7, -1):
        with pytest.raises(FileNotFoundError, match=f"no version {version} "):
            versioned.read_version(spark, path, version)
