import datetime as dt

from pyspark.sql import functions as F

from kilowatt import fixtures as fx
from kilowatt.operators import bronze, gold
from kilowatt.session import scratch_path
from kilowatt.sinks import layers
from tests.conftest import SF_TINY


def test_create_or_replace_and_view(spark):
    p = scratch_path(spark, "t-layer")
    layers.create_or_replace(spark.range(3), p)
    layers.create_or_replace(spark.range(5).withColumn("x", F.lit(1)), p)  # schema may change
    back = layers.read_layer(spark, p)
    assert back.count() == 5 and "x" in back.columns
    layers.register_view(back, "kilowatt_t_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM kilowatt_t_view").first()["n"] == 5


def test_audit_columns_and_batch_id(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 1),)], "timestamp timestamp")
    now = F.lit(dt.datetime(2024, 3, 6)).cast("timestamp")
    out = bronze.with_audit(df, source="sites.csv", batch_id="20240306_000000", now=now,
                            partition_from="timestamp").first()
    assert (out["_source_file"], out["_batch_id"], out["_year"], out["_month"]) == \
        ("sites.csv", "20240306_000000", 2024, 3)
    assert out["_ingested_at"] == dt.datetime(2024, 3, 6)
    assert bronze.batch_id_for(dt.datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405"


def test_computed_at_is_injectable(spark):
    p = spark.createDataFrame([(dt.date(2024, 1, 1), "S1", "solar", "n", "r", 1.0, 5.0, "OK")],
                              "date date, site_id string, technology string, site_name string, region string, "
                              "capacity_mw double, production_kwh double, status string")
    ts = dt.datetime(2024, 2, 1)
    d = gold.daily_kpis(p, computed_at=F.lit(ts)).first()
    assert d["computed_at"] == ts


def test_observed_quality_in_same_pass(spark):
    r = fx.solar_raw(spark, SF_TINY)
    df, obs = bronze.observe_quality(r, "t_obs")
    p = scratch_path(spark, "t-obs")
    df.write.parquet(p)
    m = obs.get
    assert m["total_rows"] == r.count()
    assert m["negative_production"] == r.filter("production_kwh < 0").count()


def test_medallion_end_to_end(spark):
    from kilowatt.plans import medallion
    from kilowatt.plans.queries import _landing_layout
    root = scratch_path(spark, "t-lake")
    lake = medallion.Lake(f"{root}/lake")
    metrics = medallion.bronze_job(spark, _landing_layout(spark, SF_TINY, root), lake, "b1")
    assert metrics["solar_raw"]["total_rows"] == fx.solar_raw(spark, SF_TINY).count()
    medallion.silver_job(spark, lake)
    medallion.gold_job(spark, lake)
    silver_df = layers.read_layer(spark, lake.table("silver", "production"))
    assert silver_df.groupBy("timestamp", "site_id", "technology").count().filter("count > 1").count() == 0
    daily = layers.read_layer(spark, lake.table("gold", "daily_kpis"))
    assert daily.count() > 0 and "computed_at" in daily.columns


def test_layer_reads_prune_partitions_and_push_filters(spark):
    from kilowatt.plans import medallion
    from kilowatt.plans.queries import _landing_layout
    root = scratch_path(spark, "t-lake2")
    lake = medallion.Lake(f"{root}/lake")
    medallion.bronze_job(spark, _landing_layout(spark, SF_TINY, root), lake, "b1")
    medallion.silver_job(spark, lake)
    df = (layers.read_layer(spark, lake.table("silver", "production"))
          .filter((F.col("date") == F.lit("2024-01-05").cast("date")) & (F.col("site_id") == "42"))
          .select("timestamp", "production_kwh"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    part_filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "date" in part_filters
    assert "PushedFilters: [IsNotNull(site_id), EqualTo(site_id,42)]" in plan
    read_schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(read_schema.split(",")) == ["production_kwh:double", "site_id:string", "timestamp:timestamp"]
