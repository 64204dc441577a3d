"""Bronze layer: audit columns and measure-not-reject quality profiles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kilowatt import constants as K
from kilowatt.functions.expressions import count_when


def batch_id_for(now: datetime | None = None) -> str:
    """Batch id text ``%Y%m%d_%H%M%S`` of the ingest time."""
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")


def with_audit(df: DataFrame, source: str | Column | None = None, batch_id: str | None = None,
               now: Column | None = None, partition_from: str | None = None,
               metadata: bool = True) -> DataFrame:
    """Add ``_ingested_at``, ``_source_file`` (literal ``source`` or the real
    file path from ``_metadata`` when reading files), optional ``_batch_id`` and,
    with ``partition_from``, the ``_year`` / ``_month`` partition columns.
    The same projection is used for batch and streaming reads."""
    cols: dict[str, Column] = {"_ingested_at": now if now is not None else F.current_timestamp()}
    if isinstance(source, str):
        cols["_source_file"] = F.lit(source)
    elif source is not None:
        cols["_source_file"] = source
    elif metadata:
        cols["_source_file"] = F.col("_metadata.file_path")
    if batch_id is not None:
        cols["_batch_id"] = F.lit(batch_id)
    if partition_from is not None:
        cols["_year"] = F.year(partition_from)
        cols["_month"] = F.month(partition_from)
    return df.withColumns(cols)


PROFILE_INPUTS = ["site_id", "production_kwh", "status"]


def quality_profile(tables: dict[str, DataFrame], ts: str = "timestamp") -> DataFrame:
    """One profile row per named bronze table, computed as ONE aggregate grouped by table name over
    the tagged union of the tables: a single distinct-count pipeline instead
    of one per table."""
    tagged = None
    for name, df in tables.items():
        t = df.select(F.lit(name).alias("table_name"), *PROFILE_INPUTS, F.col(ts).alias("_ts"))
        tagged = t if tagged is None else tagged.unionByName(t)
    p = F.col("production_kwh")
    return tagged.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("site_id").alias("distinct_sites"),
        count_when(p.isNull()).alias("null_production"),
        count_when(p < 0).alias("negative_production"),
        count_when(F.col("status") == K.OFFLINE).alias("offline_records"),
        F.min("_ts").alias("min_ts"),
        F.max("_ts").alias("max_ts"),
    )


def observe_quality(df: DataFrame, name: str = "bronze_quality") -> tuple[DataFrame, Observation]:
    """Attach the bronze profile metrics to ``df`` as an observation: they are
    computed in the same pass as whatever action (e.g. the bronze write)
    runs on the returned frame — no second scan. Read ``obs.get`` after it."""
    obs = Observation(name)
    p = F.col("production_kwh")
    return df.observe(
        obs,
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(p.isNull(), 1).otherwise(0)).alias("null_production"),
        F.sum(F.when(p < 0, 1).otherwise(0)).alias("negative_production"),
        F.sum(F.when(F.col("status") == K.OFFLINE, 1).otherwise(0)).alias("offline_records"),
        F.min("timestamp").alias("min_ts"),
        F.max("timestamp").alias("max_ts"),
    ), obs
