"""Incremental ingest of landing files (exactly once per file).

``stream_csv`` is a file-source stream that only picks up files it has not
seen (the checkpoint remembers them); ``run_incremental`` drains everything
available with ``availableNow`` and stops — a batch-style incremental job.
Use one checkpoint per target table."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from kilowatt.operators.bronze import with_audit


def stream_csv(spark: SparkSession, path: str, schema: StructType, glob: str | None = "*.csv",
               header: bool = True, max_files_per_trigger: int | None = None,
               timestamp_format: str | None = None) -> DataFrame:
    """Streaming CSV source over a landing folder. ``glob`` keeps foreign files
    (other kinds dropped in the same folder) out of a stream whose schema
    would map them by position."""
    r = spark.readStream.schema(schema).option("header", header)
    if timestamp_format:  # default: Spark's lenient ISO timestamp parser
        r = r.option("timestampFormat", timestamp_format)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def run_incremental(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet", timeout_s: float | None = None) -> StreamingQuery:
    """Append every available new input to ``path`` and stop (trigger
    availableNow). Rerunning with the same checkpoint adds only files that
    arrived since the last run."""
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(path)
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"incremental ingest into {path} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q


#: Seconds that a drained stream's last progress may take to be reported.
LISTENER_WAIT_S = 60
QUALITY_METRICS = ("total_rows", "null_production", "negative_production", "offline_records")


class _Totals(StreamingQueryListener):
    """Sums the metrics that one stream observes, over all of its batches."""

    def __init__(self, name: str):
        self.name, self.totals, self.ended = name, dict.fromkeys(QUALITY_METRICS, 0), threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        for k, v in (row.asDict() if row is not None else {}).items():
            self.totals[k] += int(v or 0)

    def onQueryTerminated(self, event) -> None:
        self.ended.set()  # events come in order: all progress has been seen


def ingest_stream(spark: SparkSession, landing: str, schema: StructType, target: str,
                  checkpoint: str, glob: str | None = "*.csv", ts: str = "timestamp",
                  timeout_s: float | None = None, batch_id: str | None = None) -> dict[str, int]:
    """Landing CSV → audit columns (same projection as batch, incl. the
    ``_year``/``_month`` partition columns) → append to ``target``. Quality
    counts are observed per micro-batch in the same pass (measure, don't
    reject); returned are their sums over all batches of the run."""
    name = f"bronze_quality_{uuid.uuid4().hex[:8]}"
    s = with_audit(stream_csv(spark, landing, schema, glob), partition_from=ts, batch_id=batch_id)
    p = F.col("production_kwh")
    counts = (F.count(F.lit(1)), F.count_if(p.isNull()), F.count_if(p < 0), F.count_if(F.col("status") == "OFFLINE"))
    s = s.observe(name, *[c.alias(n) for c, n in zip(counts, QUALITY_METRICS)])
    totals = _Totals(name)
    spark.streams.addListener(totals)
    try:
        run_incremental(s, target, checkpoint, timeout_s=timeout_s)
        if not totals.ended.wait(LISTENER_WAIT_S):
            raise TimeoutError(f"the quality counts of the ingest into {target} are not complete after {LISTENER_WAIT_S} s")
    finally:
        spark.streams.removeListener(totals)
    return totals.totals
