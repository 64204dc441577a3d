"""File sources (S1–S4, S6, S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A parquet table ``{base}/{name}.parquet`` (a file or a folder)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, glob: str | None = None, header: bool = True,
             timestamp_format: str | None = None, mode: str = "PERMISSIVE",
             ) -> DataFrame:
    """CSV landing files.

    * no ``schema`` and ``infer=False``: every column is a string (S1);
    * ``infer=True``: typed by an extra scan over the whole input (S2);
    * ``schema``: declared types, malformed values → NULL in PERMISSIVE mode (S3).
    ``glob`` keeps only matching file names (e.g. ``"solar_*.csv"``).
    Without ``timestamp_format`` Spark's lenient ISO parser reads both
    ``2024-01-01 00:00:00`` and ``2024-01-01T00:00:00.123456``.
    """
    r = spark.read.option("header", header).option("mode", mode)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def with_provenance(df: DataFrame, column: str = "_source_file") -> DataFrame:
    """Add the path of the file each row came from (S4, hidden ``_metadata``)."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def file_inventory(spark: SparkSession, path: str, glob: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """path, name, size_bytes, modified_at of the files under ``path`` (S9).

    Listing is distributed by the file source; file contents are not read
    (only the selected metadata columns are projected)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(path)
    return df.select(
        F.col("path"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )
