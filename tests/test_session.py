from kilowatt import session


def test_scale_conf_for_100tb():
    conf = session.scale_conf(100 * 1024 ** 4, total_cores=8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts == 409_600                          # ~256 MB per reducer before AQE coalescing
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = session.scale_conf(10 * 1024 ** 2, total_cores=16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32   # never fewer than two waves


def test_scratch_and_checkpoint_live_under_the_checkpoint_dir(spark):
    base = session.ensure_checkpoint_dir(spark)
    assert session.scratch_path(spark, "x").startswith(base.rstrip("/") + "/kilowatt-scratch/x-")
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    cut = session.stored(df, "cut")
    assert cut.count() == 10 and cut.dtypes == df.dtypes
    assert "Range" not in cut._jdf.queryExecution().analyzed().toString()  # lineage replaced


def test_a_cluster_must_name_shared_storage(monkeypatch, spark):
    import pytest

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster)
    Cluster.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster)
