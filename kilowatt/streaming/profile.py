"""A bronze quality profile that grows with the stream (A4, A12, X6).

Counts and first and last times add up from batch to batch; a number of distinct
sites does not. So each site gets a number when it is first seen, a micro-batch
keeps the bitmaps of the numbers it has met (32,768 sites in each), and the
profile counts the bits of their union: exact, whatever the order, and a few
kilobytes per batch. All that a batch leaves behind (rows, bitmaps, counts, new
sites) lies in folders of its own that a replayed batch writes again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kilowatt import constants as K
from kilowatt.operators.bronze import with_audit
from kilowatt.operators.ranking import global_rank
from kilowatt.session import path_exists, stored
from kilowatt.streaming.ingest import stream_csv
from kilowatt.streaming.upsert import stream_id

BATCH = "_batch"
FIGURES = ("total_rows", "distinct_sites", "null_production", "negative_production", "offline_records", "min_ts", "max_ts")
_COUNTS = "total_rows long, null_production long, negative_production long, offline_records long, min_ts timestamp_ntz, max_ts timestamp_ntz"
_BITMAPS = "bucket long, bitmap binary"


def _replace(df: DataFrame, path: str, batch: str) -> None:
    df.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    whole = f"{schema}, {BATCH} string"
    return spark.read.schema(whole).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], whole)


def _named(batch: str, known: bool) -> Column:
    return F.col(BATCH) != batch if known else F.col(BATCH) == batch


def number_sites(spark: SparkSession, sites: DataFrame, path: str, batch: str) -> DataFrame:
    """``sites(site)`` with their numbers from 1 on; those met for the first time
    get the next ones and are added to the list at ``path``. Only new sites are
    ranked, in value ranges."""
    known = _read(spark, path, "site string, number long").filter(_named(batch, True)).select("site", "number")  # not those of a lost try
    new = stored(sites.join(known, "site", "left_anti"), "new_sites")
    top = known.agg(F.max("number").alias("n")).first()["n"] or 0
    if new.limit(1).count():
        _replace(global_rank(new, "site", descending=False).select("site", (F.col("row_number") + top).alias("number")), path, batch)
    return sites.join(_read(spark, path, "site string, number long").select("site", "number"), "site")


def profile_batch(rows: DataFrame, state: str, batch: str, ts: str = "timestamp") -> None:
    """Leaves the partial figures of one batch below ``state``."""
    spark = rows.sparkSession
    p = F.col("production_kwh")
    counts = rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(p.isNull()).alias("null_production"), F.count_if(p < 0).alias("negative_production"),
                      F.count_if(F.col("status") == K.OFFLINE).alias("offline_records"),
                      F.min(F.col(ts).cast("timestamp_ntz")).alias("min_ts"), F.max(F.col(ts).cast("timestamp_ntz")).alias("max_ts"))
    sites = rows.filter("site_id is not null").select(F.col("site_id").cast("string").alias("site")).distinct()
    numbered = number_sites(spark, sites, f"{state}/sites", batch)
    bitmaps = numbered.groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    _replace(bitmaps, f"{state}/bitmaps", batch)
    _replace(counts, f"{state}/counts", batch)


def profile(spark: SparkSession, state: str) -> DataFrame:
    """The seven figures over all batches so far, one row (no batch: zeros and NULLs)."""
    counts = _read(spark, f"{state}/counts", _COUNTS).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("total_rows", "null_production", "negative_production", "offline_records")],
        F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))
    sites = _read(spark, f"{state}/bitmaps", _BITMAPS).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")).agg(
        F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias("distinct_sites"))
    return counts.join(sites).select(*FIGURES)  # one row each


def ingest_profiled(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str, state: str, glob: str | None = "*.csv",
                    ts: str = "timestamp", batch_id: str | None = None, max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> DataFrame:
    """Drains new landing files (availableNow) into ``target`` with audit columns, as
    :func:`ingest_stream` does, and keeps the profile below ``state``. Returns the
    profile over everything ingested so far."""
    stream = with_audit(stream_csv(spark, landing, schema, glob, max_files_per_trigger=max_files_per_trigger), partition_from=ts, batch_id=batch_id)

    def ingest(rows: DataFrame, n: int) -> None:
        batch = f"{stream_id(rows.sparkSession, checkpoint)}-{n}"
        _replace(rows, target, batch)
        written = rows.sparkSession.read.parquet(f"{target}/{BATCH}={batch}")  # the batch's own folder, three columns of it
        profile_batch(written, state, batch, ts)

    q = stream.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if done is False:
        q.stop()
        raise TimeoutError(f"ingest into {target} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return profile(spark, state)
