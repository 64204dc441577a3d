"""Upserts into a plain parquet table: only the partitions a batch touches are
written again, the files of all others stay as they are.

A write has two steps. The new rows of the touched partitions are written to a
folder of their own below the table (``_pending/…``), closed by a list of the
partitions that are left without rows. Then dynamic partition overwrite puts
them in place, and the emptied partitions are removed. A job lost in the first
step leaves the table as it was. One lost in the second leaves a closed folder,
which the next write (or :func:`finish_pending`) puts in place again: the rows
are the same, so doing it twice changes nothing. While partitions are being
put in place, a reader may see some of them new and some old. One writer at a
time; nothing here keeps old rows (for time travel use versioned tables).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kilowatt.operators.merge import READING_KEYS, merge_upsert, recent
from kilowatt.operators.silver import dedup_keep_best
from kilowatt.session import list_folder, path_exists, remove_folder
from kilowatt.sinks.versioned import ACTIONS, touched_values

PENDING = "_pending"


def in_values(col: str, values: Sequence) -> Column:
    """``col`` is one of ``values`` (None: NULL), never NULL itself: a partition filter."""
    return F.coalesce(F.col(col).isin([v for v in values if v is not None]), F.lit(None in values))


def read_partitions(spark: SparkSession, path: str, like: StructType, partition_col: str = "date") -> DataFrame:
    """The table at ``path``; its partition column has the type it has in ``like``
    (folder names alone don't tell it where all values are NULL). A table that
    doesn't exist yet, or has lost its last row, is empty with the columns of ``like``."""
    try:
        found = spark.read.parquet(path).schema if path_exists(spark, path) else like
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        found = like
    if partition_col not in found.names:
        found = like
    schema = StructType([StructField(f.name, like[f.name].dataType if f.name == partition_col else f.dataType) for f in found])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _put_in_place(spark: SparkSession, path: str, pending: str, partition_col: str) -> None:
    rows = spark.read.parquet(f"{pending}/rows")
    rows.hint("rebalance", partition_col).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    for r in spark.read.schema("folder string").parquet(f"{pending}/emptied").collect():  # folders: at most the touched dates
        remove_folder(spark, r["folder"])
    remove_folder(spark, pending)


def finish_pending(spark: SparkSession, path: str, partition_col: str = "date") -> int:
    """Carries out what an earlier, lost job had closed, and clears away what it
    had not. Returns how many writes were carried out."""
    done = 0
    where = f"{path.rstrip('/')}/{PENDING}"
    for folder in sorted(list_folder(spark, where)) if path_exists(spark, where) else []:
        if path_exists(spark, f"{folder}/emptied/_SUCCESS"):
            _put_in_place(spark, path, folder, partition_col)
            done += 1
        else:
            remove_folder(spark, folder)
    return done


def replace_partitions(rows: DataFrame, path: str, before: DataFrame, partition_col: str = "date",
                       action_col: str | None = None) -> dict[str, int]:
    """Puts ``rows`` in the place of ``before``, the rows of the same partitions as
    the table has them now. With ``action_col`` (a merge's ``_action``) deleted
    rows are left out. Returns the rows per action, or ``rows`` alone."""
    spark = rows.sparkSession
    path = path.rstrip("/")
    pending = f"{path}/{PENDING}/{uuid.uuid4().hex[:12]}"
    obs = Observation(f"replace_{uuid.uuid4().hex[:12]}")
    counts = [F.count_if(F.col(action_col) == x).alias(x) for x in ACTIONS] if action_col else [F.count(F.lit(1)).alias("rows")]
    rows = rows.observe(obs, *counts)
    if action_col:
        rows = rows.filter(F.col(action_col) != "delete").drop(action_col)
    rows.write.parquet(f"{pending}/rows")
    new = set(touched_values(spark.read.parquet(f"{pending}/rows"), partition_col))
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    old = before.select(F.col(partition_col), folder.alias("folder")).distinct().collect() if before.inputFiles() else []  # one per partition
    emptied = [(r["folder"],) for r in old if r[partition_col] not in new]
    spark.createDataFrame(emptied, "folder string").coalesce(1).write.parquet(f"{pending}/emptied")
    _put_in_place(spark, path, pending, partition_col)
    return {k: int(v) for k, v in obs.get.items()}


def write_partitions(df: DataFrame, path: str, partition_col: str = "date") -> None:
    """A new table of ``df``, or the whole table written anew."""
    df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path)


def merge_partitions(path: str, source: DataFrame, keys: Sequence[str] = READING_KEYS, compare: Sequence[str] = ("production_kwh",),
                     as_of=None, recent_days: int | None = 7, partition_col: str = "date", null_safe: bool = False) -> dict[str, int]:
    """MERGE ``source`` into the table at ``path`` in place. Only partitions of the
    source's dates (NULL included) and of the delete window are read, joined and
    written; the date must follow from the keys. Returns the rows per action in
    these partitions."""
    spark = source.sparkSession
    finish_pending(spark, path, partition_col)
    target = read_partitions(spark, path, source.schema, partition_col)
    touched = touched_values(source, partition_col)
    before = target.filter(in_values(partition_col, touched) | recent(partition_col, as_of, recent_days))
    plan = merge_upsert(before, source, keys, compare, as_of, recent_days, partition_col, null_safe, keep_deleted=True)
    return replace_partitions(plan, path, before, partition_col, "_action")


def upsert_best(path: str, batch: DataFrame, keys: Sequence[str] = READING_KEYS, value: str = "production_kwh",
                tiebreak: Sequence[str] = (), partition_col: str = "date") -> list:
    """Of all readings of a key, those in the table and those of ``batch``, the best
    stays; only the batch's partitions are read and written. The choice is a
    maximum, so a batch that comes twice changes nothing. Returns the batch's dates."""
    spark = batch.sparkSession
    finish_pending(spark, path, partition_col)
    touched = touched_values(batch, partition_col)
    if touched:
        before = read_partitions(spark, path, batch.schema, partition_col).filter(in_values(partition_col, touched))
        best = dedup_keep_best(before.unionByName(batch.select(*before.columns)), keys, value, tiebreak)
        replace_partitions(best, path, before, partition_col)
    return touched
