"""Roll readings up to a coarser time scale, and derived energy losses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilowatt.functions.expressions import DEFAULT_SCALE, exact, exact_avg, exact_sum, round_double

UNITS = ("minute", "hour", "day")


def timescale_rollup(df: DataFrame, unit: str, ts: str = "timestamp",
                     keys: Sequence[str] = ("site_id", "technology"),
                     value: str = "production_kwh", scale: int = DEFAULT_SCALE) -> DataFrame:
    """Per (keys, ``unit`` bucket): readings, total / mean / peak ``value``.
    A plain hash aggregate (partial per task), so hot keys are pre-combined."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    v = F.col(value)
    return (df.groupBy(*keys, F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType).alias("bucket_start"))
            .agg(F.count(F.lit(1)).alias("n_readings"),
                 round_double(exact_sum(v, scale), 4).alias("total_kwh"),
                 round_double(exact_avg(v, scale), 4).alias("avg_kwh"),
                 F.max(v).alias("max_kwh"))
            .withColumn("unit", F.lit(unit)))


def multi_scale_rollup(df: DataFrame, units: Sequence[str] = UNITS, ts: str = "timestamp",
                       keys: Sequence[str] = ("site_id", "technology"),
                       value: str = "production_kwh", scale: int = DEFAULT_SCALE) -> DataFrame:
    """:func:`timescale_rollup` at several units in ONE pass over the readings:
    aggregated once at the finest unit (partial aggregation per task), every
    coarser unit rolled up from the finer unit's partial results (exact sums
    and counts add, the max of maxima is the max, the mean is sum / count), so
    raw rows are neither rescanned nor expanded per unit."""
    if any(u not in UNITS for u in units):
        raise ValueError(f"unit must be one of {UNITS}")
    order = sorted(units, key=UNITS.index)
    t = df.schema[ts].dataType
    v = F.col(value)
    level = (df.groupBy(*keys, F.date_trunc(order[0], F.col(ts)).cast(t).alias("bucket_start"))
             .agg(F.count(F.lit(1)).alias("n_readings"),
                  exact_sum(v, scale).alias("_sum"),
                  F.count(v).alias("_n"),
                  F.max(v).alias("max_kwh")))
    levels = {order[0]: level}
    for u in order[1:]:
        level = (level.groupBy(*keys, F.date_trunc(u, F.col("bucket_start")).cast(t).alias("bucket_start"))
                 .agg(F.sum("n_readings").alias("n_readings"), F.sum("_sum").alias("_sum"),
                      F.sum("_n").alias("_n"), F.max("max_kwh").alias("max_kwh")))
        levels[u] = level
    parts = [lv.select(*keys, "bucket_start", "n_readings",
                       round_double(F.col("_sum"), 4).alias("total_kwh"),
                       round_double(F.col("_sum") / F.nullif(F.col("_n"), F.lit(0)), 4).alias("avg_kwh"),
                       "max_kwh", F.lit(u).alias("unit"))
             for u, lv in levels.items()]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def energy_losses(daily: DataFrame, site_keys: Sequence[str] = ("site_id", "technology"),
                  scale: int = DEFAULT_SCALE) -> DataFrame:
    """Estimated energy lost to outages per site-day (our own formula — the
    reference names the KPI without one): offline hours × capacity (MW) ×
    the site's mean daily capacity factor, in MWh. NULL when capacity or the
    mean capacity factor is unknown."""
    w = Window.partitionBy(*site_keys)
    mean_cf = F.avg(exact("daily_capacity_factor_pct", scale)).over(w).cast("decimal(14,8)")
    # bounded precisions keep the product exact (wide operands make Spark
    # drop result scale to 6 digits)
    lost = (F.col("hours_offline").cast("decimal(6,0)") * F.col("capacity_mw").cast("decimal(14,6)")
            * mean_cf / 100)
    return daily.select("date", *site_keys, "hours_offline", "capacity_mw",
                        round_double(mean_cf, 4).alias("mean_capacity_factor_pct"),
                        F.when(F.col("capacity_mw") > 0, round_double(lost, 4))
                        .otherwise(F.lit(None).cast("double")).alias("energy_lost_mwh"))
