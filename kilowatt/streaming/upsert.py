"""Incremental silver: a stream of readings merged into a table.

Each micro-batch is transformed and merged into the table by the keep-best rule
of the batch job: of all readings of a key, old and new, the best stays (a
value beats NULL, the higher value wins, ties by the given columns). That
choice is a maximum under a total order, so any sequence of batches ends where
one batch over all files does, and a batch replayed after a failure (the sink
is at-least-once) changes nothing.

``upsert_stream`` works in place: a batch rewrites the partitions of its own
dates and no others. ``version_stream`` makes a version of every batch instead,
which keeps history and copies the whole table each time; a commit records the
stream's own id and the batch id, so a replayed batch makes no second version.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilowatt.operators.merge import READING_KEYS
from kilowatt.operators.silver import dedup_keep_best
from kilowatt.sinks import partitioned, versioned

TIEBREAK = ("status", "sensor_metric_1", "sensor_metric_2")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its stream: a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def merge_micro_batch(batch: DataFrame, batch_id: int, path: str, transform: Callable[[DataFrame], DataFrame],
                      stream: str, keys: Sequence[str] = READING_KEYS, value: str = "production_kwh",
                      tiebreak: Sequence[str] = TIEBREAK, partition_col: str = "date") -> int | None:
    """Merge one micro-batch; returns the new version, or None when the batch
    was already committed (a replay) or is empty."""
    spark = batch.sparkSession
    op = f"STREAM MERGE {stream}#{batch_id}"
    if versioned.commits(spark, path).filter(F.col("operation") == op).limit(1).count():
        return None  # replay of a committed batch
    src = transform(batch).persist()  # read for its dates and for the merge
    try:
        touched = versioned.touched_values(src, partition_col)
        if not touched:
            return None
        if versioned.latest_version(spark, path) is None:
            return versioned.write_version(dedup_keep_best(src, keys, value, tiebreak), path, op, partition_col, touched=touched)
        target = versioned.read_version(spark, path)
        hit = F.coalesce(F.col(partition_col).isin([v for v in touched if v is not None]), F.lit(None in touched))
        best = dedup_keep_best(target.filter(hit).unionByName(src), keys, value, tiebreak)
        rows = best.select(*target.columns).unionByName(target.filter(~hit))
        return versioned.write_version(rows.hint("rebalance", partition_col), path, op, partition_col, touched=touched)
    finally:
        src.unpersist()


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame],
                  keys: Sequence[str] = READING_KEYS, value: str = "production_kwh", tiebreak: Sequence[str] = TIEBREAK,
                  partition_col: str = "date", timeout_s: float | None = None, announce: Callable[[DataFrame], None] | None = None) -> list:
    """Drain ``stream`` (availableNow) into the partitioned table at ``path``, in
    place. Returns the dates that the batches of this run touched. ``announce`` is
    given each batch's dates before the table changes, for those who must not
    miss one whatever happens."""
    dates: set = set()

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        src = transform(batch).persist()  # read for its dates and for the merge
        try:
            if announce:
                announce(src.select(partition_col).distinct())
            dates.update(partitioned.upsert_best(path, src, keys, value, tiebreak, partition_col))
        finally:
            src.unpersist()

    _drain(stream, merge_batch, path, checkpoint, timeout_s)
    return sorted(dates, key=lambda v: (v is None, str(v)))


def version_stream(stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame],
                   keys: Sequence[str] = READING_KEYS, value: str = "production_kwh", tiebreak: Sequence[str] = TIEBREAK,
                   partition_col: str = "date", timeout_s: float | None = None) -> StreamingQuery:
    """Drain ``stream`` (availableNow) into the versioned table at ``path``, a version per batch."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        merge_micro_batch(batch, batch_id, path, transform, stream_id(batch.sparkSession, checkpoint), keys, value,
                          tiebreak, partition_col)

    return _drain(stream, merge_batch, path, checkpoint, timeout_s)


def _drain(stream: DataFrame, merge_batch: Callable[[DataFrame, int], None], path: str, checkpoint: str,
           timeout_s: float | None) -> StreamingQuery:
    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if done is False:
        q.stop()
        raise TimeoutError(f"stream upsert into {path} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q
