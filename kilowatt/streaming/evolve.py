"""Incremental ingest of CSV files whose columns change from drop to drop (S5).

The stream is one of files: a micro-batch is a bounded list of new paths. Each
file's header says what its columns are, files of one header are read together
by name, and the known schema lies beside the checkpoint. A column that nobody
declared is added to it as text; one that a file lacks is NULL there; a value
that isn't of its column's type sends its record aside with the reason. A type
that differs from the stored one stops the job before it reads anything.
"""

from __future__ import annotations

import csv
import json
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from kilowatt.session import path_exists
from kilowatt.sources import checked

BATCH = "_batch"
_FILES = "path string, modificationTime timestamp, length long, content binary"


class SchemaChanged(ValueError):
    pass


def stored_schema(spark: SparkSession, checkpoint: str) -> StructType | None:
    """The schema known so far, None before the first run."""
    where = f"{checkpoint.rstrip('/')}/_schema"
    if not path_exists(spark, where):
        return None
    row = spark.read.schema("version int, schema string").parquet(where).agg(F.max_by("schema", "version").alias("schema")).first()
    return None if row["schema"] is None else StructType.fromJson(json.loads(row["schema"]))


def _store(spark: SparkSession, checkpoint: str, schema: StructType) -> None:
    where = f"{checkpoint.rstrip('/')}/_schema"
    n = spark.read.schema("version int").parquet(where).count() if path_exists(spark, where) else 0
    spark.createDataFrame([(n, schema.json())], "version int, schema string").coalesce(1).write.mode("append").parquet(where)


def agreed_schema(known: StructType | None, declared: StructType) -> StructType:
    """The stored schema with newly declared columns added. A column declared with
    another type than the stored one is an error; one no longer declared stays."""
    if known is None:
        return declared
    changed = [f"{f.name}: {known[f.name].dataType.simpleString()} is stored, {f.dataType.simpleString()} declared"
               for f in declared if f.name in known.names and known[f.name].dataType != f.dataType]
    if changed:
        raise SchemaChanged("; ".join(changed))
    return StructType([*known.fields, *[f for f in declared if f.name not in known.names]])


def with_columns(schema: StructType, header: Sequence[str]) -> StructType:
    """``schema`` with the header's unknown columns added as text."""
    return StructType([*schema.fields, *[StructField(c, StringType(), True) for c in dict.fromkeys(header) if c not in schema.names]])


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task, which then stops reading."""
    for b in batches:
        if b.num_rows:
            yield b.slice(0, 1)
            return


def headers(spark: SparkSession, paths: Sequence[str], delimiter: str = ",") -> dict[str, tuple[str, ...]]:
    """The header of each file. Every split of a file is a task of its own here,
    which ends after its first line, so no file is read through."""
    keys = {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes"), "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
        rows = lines.mapInArrow(_first_rows, "value string, path string, start long").filter("start = 0").collect()  # one per path
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = {}
    for r in rows:
        header = tuple(next(csv.reader([r["value"]], delimiter=delimiter)))
        if len(set(header)) < len(header):
            raise SchemaChanged(f"{r['path']}: a column occurs twice in {header}")
        found[r["path"]] = header
    return found


def _read(spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: StructType, required: Sequence[str],
          delimiter: str, timestamp_format: str | None) -> DataFrame:
    """Files of one header, checked, in the columns of ``schema``."""
    own = StructType([StructField(c, schema[c].dataType, True) for c in header])
    raw = spark.read.schema(checked.with_raw(own)).options(**checked.reader_options(True, timestamp_format, delimiter)).csv(paths)
    raw = raw.withColumn("_source_file", F.col("_metadata.file_path"))
    records = checked.checked(raw, own, [c for c in required if c in header], delimiter)
    absent = [c for c in required if c not in header]
    if absent:  # nothing of such a file can be accepted
        records = records.withColumns({checked.REASON: F.coalesce(checked.REASON, F.lit(f"{absent[0]}: missing")), checked.REJECTED: F.lit(True)})
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in header}
    return records.withColumns(missing).select(*schema.names, "_source_file", checked.RAW, checked.REASON, checked.REJECTED)


def ingest_changing(spark: SparkSession, landing: str, declared: StructType, target: str, checkpoint: str, required: Sequence[str] = (),
                    glob: str = "*.csv", files_per_batch: int = 1000, delimiter: str = ",", timestamp_format: str | None = None,
                    timeout_s: float | None = None) -> StructType:
    """Drains new files below ``landing`` into ``target`` (availableNow) and returns
    the schema as it is then known. A batch is a partition of the target, written
    anew where it is replayed, so each file counts once. Empty files have no
    header and no rows."""
    schema = agreed_schema(stored_schema(spark, checkpoint), declared)
    if schema != stored_schema(spark, checkpoint):
        _store(spark, checkpoint, schema)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [r["path"] for r in batch.select("path").collect()]  # at most files_per_batch
        by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
        for path, header in headers(session, paths, delimiter).items() if paths else ():
            by_header[header].append(path)
        known = stored_schema(session, checkpoint)
        now = known
        for header in sorted(by_header):
            now = with_columns(now, header)
        if now != known:
            _store(session, checkpoint, now)
        parts = [_read(session, sorted(files), header, now, required, delimiter, timestamp_format) for header, files in sorted(by_header.items())]
        if parts:
            rows = parts[0]
            for p in parts[1:]:
                rows = rows.unionByName(p)
            rows.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                BATCH, checked.REJECTED).parquet(target)

    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", glob).option(
        "maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(landing).select("path")
    q = files.writeStream.foreachBatch(ingest).option("checkpointLocation", f"{checkpoint.rstrip('/')}/files").trigger(availableNow=True).start()
    done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if done is False:
        q.stop()
        raise TimeoutError(f"ingest into {target} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return stored_schema(spark, checkpoint)


def read_changing(spark: SparkSession, target: str, checkpoint: str) -> DataFrame:
    """All records of ``target`` in the columns known today, rejected ones with their
    raw line and reason (``_rejected`` tells them apart and prunes folders)."""
    schema = stored_schema(spark, checkpoint)
    extra = [StructField("_source_file", StringType()), StructField(checked.RAW, StringType()), StructField(checked.REASON, StringType()),
             StructField(BATCH, StringType()), StructField(checked.REJECTED, BooleanType())]
    whole = StructType([*[StructField(f.name, f.dataType, True) for f in schema], *extra])
    if not path_exists(spark, target):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(target)
