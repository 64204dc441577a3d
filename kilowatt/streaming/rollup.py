"""Streaming twins of the batch operators: event-time rollups with a
watermark (late data bounded, state dropped once a window closes) and
production-drift alerts from a stream-static join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from kilowatt import constants as K
from kilowatt.functions.expressions import DEFAULT_SCALE, alert_level, exact, exact_avg, exact_sum, round_double, zscore
from kilowatt.operators.joins import join_dimension
from kilowatt.operators.timescale import UNITS


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC") or "UTC"


def event_time(df: DataFrame, ts: str = "timestamp") -> tuple[DataFrame, bool]:
    """Watermarks need a TIMESTAMP (not TIMESTAMP_NTZ) event-time column. A
    wall-clock (NTZ) column becomes the instant whose *UTC* wall clock is the
    same, so event-time windows (aligned on the epoch) fall on whole wall-clock
    hours and days whatever the session time zone. Returns (df, was_ntz)."""
    if not isinstance(df.schema[ts].dataType, TimestampNTZType):
        return df, False
    tz = _session_tz(df)
    c = F.col(ts).cast("timestamp")
    if tz.upper() not in ("UTC", "Z", "GMT", "ETC/UTC"):
        c = F.from_utc_timestamp(c, tz)
    return df.withColumn(ts, c), True


def wall_clock(df: DataFrame, c, was_ntz: bool):
    """Inverse of :func:`event_time` for window bounds."""
    if not was_ntz:
        return c
    tz = _session_tz(df)
    if tz.upper() not in ("UTC", "Z", "GMT", "ETC/UTC"):
        c = F.to_utc_timestamp(c, tz)
    return c.cast("timestamp_ntz")


def windowed_rollup(df: DataFrame, duration: str = "1 hour", watermark: str = "10 minutes",
                    ts: str = "timestamp", keys: Sequence[str] = ("site_id", "technology"),
                    value: str = "production_kwh", scale: int = DEFAULT_SCALE) -> DataFrame:
    """Tumbling event-time windows per key with a watermark; in append mode a
    window is emitted once the watermark passes its end (closed windows only)."""
    src = df
    df, ntz = event_time(df, ts)
    v = F.col(value)
    return (df.withWatermark(ts, watermark)
            .groupBy(F.window(ts, duration).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n_readings"),
                 round_double(exact_sum(v, scale), 4).alias("total_kwh"),
                 round_double(exact_avg(v, scale), 4).alias("avg_kwh"),
                 F.max(v).alias("max_kwh"))
            .select(wall_clock(src, F.col("w.start"), ntz).alias("window_start"),
                    wall_clock(src, F.col("w.end"), ntz).alias("window_end"),
                    *keys, "n_readings", "total_kwh", "avg_kwh", "max_kwh"))


def multi_scale_stream(df: DataFrame, units: Sequence[str] = UNITS, watermark: str = "10 minutes", ts: str = "timestamp",
                       keys: Sequence[str] = ("site_id", "technology"), value: str = "production_kwh", scale: int = DEFAULT_SCALE) -> DataFrame:
    """The streaming twin of :func:`timescale.multi_scale_rollup`: one stream that
    gives the closed windows of every unit, in the batch form's columns.

    Each coarser unit is a stateful aggregation over the finer one's closed
    windows (``window_time`` carries their event time and the watermark on), so
    its state holds partial sums of windows, never readings. The finest level is
    kept once per unit that is asked for."""
    if any(u not in UNITS for u in units):
        raise ValueError(f"unit must be one of {UNITS}")
    order = sorted(units, key=UNITS.index)
    rows, ntz = event_time(df, ts)
    v = F.col(value)

    def level(upto: int) -> DataFrame:
        out = rows.withWatermark(ts, watermark).groupBy(F.window(ts, f"1 {order[0]}").alias("w"), *keys).agg(
            F.count(F.lit(1)).alias("n_readings"), exact_sum(v, scale).alias("_sum"), F.count(v).alias("_n"), F.max(v).alias("max_kwh"))
        for u in order[1:upto + 1]:
            out = out.groupBy(F.window(F.window_time("w"), f"1 {u}").alias("w"), *keys).agg(
                F.sum("n_readings").alias("n_readings"), F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.max("max_kwh").alias("max_kwh"))
        return out.select(*keys, wall_clock(df, F.col("w.start"), ntz).alias("bucket_start"), "n_readings",
                          round_double(F.col("_sum"), 4).alias("total_kwh"),
                          round_double(F.col("_sum") / F.nullif(F.col("_n"), F.lit(0)), 4).alias("avg_kwh"), "max_kwh", F.lit(order[upto]).alias("unit"))

    return reduce(DataFrame.unionByName, [level(i) for i in range(len(order))])


def site_baseline(daily: DataFrame, value: str = "total_production_mwh",
                  site_keys: Sequence[str] = ("site_id",), scale: int = DEFAULT_SCALE) -> DataFrame:
    """Static per-site baseline: mean (exact) and sample stddev of daily output."""
    return daily.groupBy(*site_keys).agg(
        F.avg(exact(value, scale)).cast("double").alias("baseline_mean"),
        F.stddev_samp(value).alias("baseline_std"),
        F.count(F.lit(1)).alias("baseline_days"))


def drift_alerts(daily_stream: DataFrame, baseline: DataFrame, value: str = "production_mwh",
                 site_keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Label each incoming site-day against its baseline (stream-static join,
    stateless). A site without a baseline keeps its row: the z-score is NULL
    and the label says so."""
    known = baseline.withColumn("_known", F.lit(True))
    j = join_dimension(daily_stream, known, list(site_keys), "left")
    return (j.withColumn("z_score", zscore(value, "baseline_mean", "baseline_std"))
            .withColumn("alert_level", F.when(F.col("_known").isNull(), K.NO_BASELINE).otherwise(alert_level("z_score")))
            .drop("_known"))


def daily_production_stream(readings_stream: DataFrame, watermark: str = "1 hour",
                            ts: str = "timestamp", keys: Sequence[str] = ("site_id",),
                            scale: int = DEFAULT_SCALE) -> DataFrame:
    """Daily MWh per site from a readings stream (negative readings → NULL)."""
    df, ntz = event_time(readings_stream, ts)
    kwh = F.when(F.col("production_kwh") < 0, F.lit(None)).otherwise(F.col("production_kwh"))
    start = wall_clock(readings_stream, F.col("w.start"), ntz)
    return (df.withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day").alias("w"), *keys)
            .agg(exact_sum(kwh, scale).alias("_kwh"))
            .select(F.to_date(start).alias("date"), *keys,
                    round_double(F.col("_kwh") / 1000, 4).alias("production_mwh")))
