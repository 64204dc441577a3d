"""Energy inputs derived from the driver's test tables (see FIXTURES.md §3).

``readings``: one hourly sensor reading per ``events`` row; ``sites``: the
site dimension from ``customer ⋈ nation ⋈ region``. Every registered query
reads these, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatt.sources.files import read_table


# FIXED VALUES (fixture mapping of event types to statuses; MAINT is not a
# valid status, so it becomes UNKNOWN after cleaning)
EVENT_STATUS = {"error": "OFFLINE", "signup": "DEGRADED", "purchase": "MAINT",
                "click": "OK", "view": "OK"}


def _status(c):
    e = F.col(c)
    items = list(EVENT_STATUS.items())
    out = F.when(e == items[0][0], items[0][1])
    for event, status in items[1:]:
        out = out.when(e == event, status)
    return out


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, timestamp, site_id, technology, production_kwh, sensor_1,
    sensor_2, status — hourly timestamps, negatives and duplicates included.
    Every tenth user is a hybrid site (both technologies); the readings of
    users with user_id % 13 = 5 name a site that the site table doesn't have;
    an irradiance may be as small as 0.00001."""
    ev = read_table(spark, sf_dir, "events")
    site = F.when(F.col("user_id") % 13 == 5, F.col("user_id") + 1_000_000).otherwise(F.col("user_id"))
    return ev.select(
        F.col("event_id"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp"),
        site.alias("site_id"),
        F.when(F.when(F.col("user_id") % 10 == 0, F.col("event_id")).otherwise(F.col("user_id")) % 2 == 0, "solar")
        .otherwise("wind").alias("technology"),
        (F.col("value") - 10).alias("production_kwh"),
        ((F.col("event_id") % 60) - 10).cast("double").alias("sensor_1"),
        (((F.col("event_id") * 37 % 1100) - 100).cast("double") + (F.col("event_id") % 7) * F.lit(0.00001)).alias("sensor_2"),
        _status("event_type").alias("status"),
    )


def solar_raw(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped solar readings (reference solar schema + event_id)."""
    r = (readings(spark, sf_dir) if rows is None else rows).filter(F.col("technology") == "solar")
    return r.select("event_id", "timestamp", "site_id",
                    F.col("sensor_1").alias("panel_temp_c"),
                    F.col("sensor_2").alias("irradiance_w_m2"),
                    "production_kwh", "status")


def wind_raw(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped wind readings (reference wind schema + event_id)."""
    r = (readings(spark, sf_dir) if rows is None else rows).filter(F.col("technology") == "wind")
    return r.select("event_id", "timestamp", "site_id",
                    F.col("sensor_1").alias("wind_speed_ms"),
                    (F.col("event_id") * 37 % 360).cast("int").alias("wind_direction_deg"),
                    "production_kwh", "status")


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = readings(spark, sf_dir)
    return {"solar": solar_raw(spark, sf_dir, rows), "wind": wind_raw(spark, sf_dir, rows)}


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site_id, site_name, region, capacity_mw, latitude, longitude."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("site_id"),
                    F.col("c_name").alias("site_name"),
                    F.col("r_name").alias("region"),
                    (F.col("c_acctbal") / 1000).alias("capacity_mw"),
                    (F.col("n_nationkey") * 3 - 30).cast("double").alias("latitude"),
                    (F.col("r_regionkey") * 30 - 60).cast("double").alias("longitude")))
