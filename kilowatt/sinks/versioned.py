"""Versioned parquet tables: every version is a whole snapshot.

    data/<folder>/…    the rows of one version, written once
    _commits/          one small row per version, naming its folder

A version becomes visible when its commit row is appended, after its files
are complete; a write that failed before leaves a folder that no commit
names. A read opens the folder of one version only: it lists no history, and
every version keeps its own columns and types. Two concurrent writers to one
table are not supported.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType,
                               TimestampType)

from kilowatt.operators.merge import READING_KEYS, merge_upsert
from kilowatt.session import path_exists

ACTIONS = ("insert", "update", "delete", "keep")
COMMIT_SCHEMA = StructType([
    StructField("version", LongType(), False),
    StructField("operation", StringType(), False),
    StructField("committed_at", TimestampType(), False),
    StructField("folder", StringType(), False),
    StructField("touched", ArrayType(StringType()), True),
    StructField("num_output_rows", LongType(), True),
    StructField("num_inserted", LongType(), True),
    StructField("num_updated", LongType(), True),
    StructField("num_deleted", LongType(), True),
    StructField("num_kept", LongType(), True),
])


def commits(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path.rstrip('/')}/_commits"
    if not path_exists(spark, where):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(where)


def latest_version(spark: SparkSession, path: str) -> int | None:
    row = commits(spark, path).agg(F.max("version").alias("v")).first()
    return None if row["v"] is None else int(row["v"])


def write_version(df: DataFrame, path: str, operation: str = "WRITE",
                  partition_col: str | Sequence[str] | None = None, action_col: str | None = None,
                  touched: Sequence | None = None) -> int:
    """Write ``df`` as the next version of the table and commit it; returns the
    version. Readers see the old version until the commit. With ``action_col``
    (a merge's ``_action``) the counts per action are recorded and deleted rows
    are not written. ``touched``: the partition values that differ from the
    version before, for readers that follow changes (None: any may)."""
    spark = df.sparkSession
    cur = latest_version(spark, path)
    n = 0 if cur is None else cur + 1
    folder = f"v{n:08d}-{uuid.uuid4().hex[:12]}"
    obs = Observation(f"kilowatt_{folder}")
    counts = [F.count(F.lit(1)).alias("rows")]
    if action_col:
        counts += [F.count_if(F.col(action_col) == x).alias(x) for x in ACTIONS]
    df = df.observe(obs, *counts)
    if action_col:
        df = df.filter(F.col(action_col) != "delete").drop(action_col)
    parts = [partition_col] if isinstance(partition_col, str) else list(partition_col or [])
    df.write.partitionBy(*parts).parquet(f"{path.rstrip('/')}/data/{folder}")
    m = obs.get
    row = (n, operation, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), folder,
           None if touched is None else [None if v is None else str(v) for v in touched],
           int(m["rows"]) - (int(m["delete"]) if action_col else 0),
           *(int(m[x]) if action_col else None for x in ACTIONS))
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_commits")
    return n


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (None: the latest). A version that was never
    committed is an error."""
    log = commits(spark, path)
    if version is not None:
        log = log.filter(F.col("version") == version)
    row = log.agg(F.max_by("folder", "version").alias("folder")).first()
    if row["folder"] is None:
        raise FileNotFoundError(f"no version {'' if version is None else version} committed in {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/data/{row['folder']}")


def history(spark: SparkSession, path: str) -> DataFrame:
    """DESCRIBE HISTORY: one row per committed version, newest first."""
    return commits(spark, path).select("version", "operation", "committed_at", "num_output_rows", "num_inserted",
                                       "num_updated", "num_deleted", "num_kept").orderBy(F.col("version").desc())


def touched_values(source: DataFrame, partition_col: str) -> list:
    """The source's partition values (dates: a list that doesn't grow with the
    rows), NULL as None."""
    return sorted((r[0] for r in source.select(partition_col).distinct().collect()), key=lambda v: (v is None, str(v)))


def merge_into(path: str, source: DataFrame, keys: Sequence[str] = READING_KEYS,
               compare: Sequence[str] = ("production_kwh",), as_of=None, recent_days: int | None = 7,
               partition_col: str = "date", null_safe: bool = False, operation: str = "MERGE") -> int:
    """MERGE INTO the table at ``path``, partitioned by its date column: upsert
    ``source`` into the latest version and commit the result as a new one. Only
    target rows of the source's dates (NULL included) and of the delete window
    are joined; the others are copied as they are."""
    target = read_version(source.sparkSession, path)
    touched = touched_values(source, partition_col)
    plan = merge_upsert(target, source, keys, compare, as_of, recent_days, partition_col, null_safe,
                        keep_deleted=True, touched=touched)
    return write_version(plan.hint("rebalance", partition_col), path, operation, partition_col, "_action",
                         touched if recent_days is None else None)
