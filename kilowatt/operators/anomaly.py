"""Rolling z-score anomalies on daily production."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilowatt import constants as K
from kilowatt.functions.expressions import alert_level, exact, round_double, zscore


def rolling_stats(daily: DataFrame, value: str = "total_production_mwh", rows: int = 30,
                  site_keys: Sequence[str] = ("site_id",), scale: int = 12) -> DataFrame:
    """Moving mean (exact) and sample stddev over the last ``rows`` rows of
    each site (the current row included); a single row has NULL stddev."""
    # a site with two technologies has two rows per date: order them too, so
    # the frames never depend on arrival order (no change with one row a day)
    extra = [c for c in ("technology",) if c in daily.columns and c not in site_keys]
    w = Window.partitionBy(*site_keys).orderBy("date", *extra).rowsBetween(-(rows - 1), 0)
    return daily.withColumns({
        f"rolling_{rows}d_avg": F.avg(exact(value, scale)).over(w).cast("double"),
        f"rolling_{rows}d_std": F.stddev_samp(value).over(w),
    })


def with_zscore(daily: DataFrame, value: str = "total_production_mwh", rows: int = 30,
                site_keys: Sequence[str] = ("site_id",)) -> DataFrame:
    s = rolling_stats(daily, value, rows, site_keys)
    return s.withColumn("z_score", zscore(value, f"rolling_{rows}d_avg", f"rolling_{rows}d_std"))


def detect_anomalies(daily: DataFrame, value: str = "total_production_mwh", rows: int = 30,
                     threshold: float = K.ANOMALY_ABS_Z, limit: int | None = 30,
                     site_keys: Sequence[str] = ("site_id",),
                     tiebreak: Sequence[str] = ("site_id", "date", "technology")) -> DataFrame:
    """Days whose |z| over the trailing ``rows``-row window exceeds
    ``threshold``, labelled by band; the ``limit`` most extreme (a top-k report
    — ``limit=None`` returns them all). NULL z (constant or 1-row history) is
    never an anomaly."""
    z = with_zscore(daily, value, rows, site_keys)
    out = (z.filter(F.abs(F.col("z_score")) > threshold)
           .select("date", "site_id", "technology",
                   round_double(exact(value), 3).alias("production_mwh"),
                   round_double(exact(f"rolling_{rows}d_avg", 12), 3).alias(f"avg_{rows}d"),
                   "z_score", alert_level("z_score").alias("alert_level")))
    if limit is None:
        return out
    return out.orderBy(F.abs(F.col("z_score")).desc(), *[F.col(c).asc() for c in tiebreak]).limit(limit)
