"""Layer writes (K1, K2, K4) and SQL registration (K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from kilowatt.sources.files import CSV_TIMESTAMP_FORMAT


def write_layer(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), max_records_per_file: int | None = None) -> str:
    """Write a layer table as parquet. ``overwrite`` replaces the table and its
    schema (a full rewrite may change columns); ``partition_by`` writes hive
    partitions the reader prunes on. Returns ``path``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def create_or_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """CREATE OR REPLACE TABLE … AS SELECT: a full overwrite of ``path``.
    (Comments / table properties have no parquet equivalent.)"""
    return write_layer(df, path, "overwrite", partition_by)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` to ``spark.sql`` under ``name`` (session scoped)."""
    df.createOrReplaceTempView(name)
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> str:
    """CSV landing files with microsecond timestamps (the default format
    would cut timestamps to milliseconds)."""
    (df.write.mode(mode).option("header", header)
     .option("timestampFormat", CSV_TIMESTAMP_FORMAT).csv(path))
    return path


def append_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Append rows to a layer table; new columns may appear in later batches
    (schema evolution — read the table back with :func:`read_layer`)."""
    return write_layer(df, path, "append", partition_by)


def read_layer(spark, path: str, merge_schema: bool = True) -> DataFrame:
    """A layer table by path (or a catalog table by name when ``path`` has no
    ``/``); a versioned table reads as its latest committed version.
    ``merge_schema`` unions the schemas of all files, so columns added by
    later appends read as NULL in older rows."""
    if "/" not in path and ":" not in path:
        return spark.table(path)
    from kilowatt.session import path_exists
    from kilowatt.sinks import versioned
    if path_exists(spark, f"{path.rstrip('/')}/_commits"):  # a versioned table: its latest version
        return versioned.read_version(spark, path)
    return spark.read.option("mergeSchema", merge_schema).parquet(path)
