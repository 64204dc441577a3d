"""Physical layout jobs: compaction, z-order clustering, sorted writes, and
partition / layer inventories. Every layout job writes a *new* location (a
table being read cannot be overwritten) and never changes the row multiset."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import (ArrayType, BinaryType, MapType, StringType, StructType, UserDefinedType,
                               VariantType)

from kilowatt.functions.expressions import common_prefix_len, order_key

#: Bytes of rows, as a sort holds them, that one range of a layout job is meant to have.
RANGE_BYTES = 256 << 20


def compact(df: DataFrame, path: str, partition_cols: Sequence[str] = (), max_records_per_file: int | None = None,
            mode: str = "overwrite") -> str:
    """Rewrite ``df`` as few, large files (OPTIMIZE). The REBALANCE hint lets
    AQE size the write tasks to the session's ``advisoryPartitionSizeInBytes``
    and split a skewed partition value over several tasks, instead of one task
    per value."""
    w = df.hint("rebalance", *partition_cols).write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(*partition_cols).parquet(path)
    return path


def z_bits(files: int, k: int) -> int:
    """Bits per column that give 16 z cells per file, 8 at least."""
    return min(62 // k, max(8, math.ceil((math.log2(max(files, 1)) + 4) / k)))


def with_zvalue(df: DataFrame, cols: Sequence[str], bits: int = 8, name: str = "_z") -> DataFrame:
    """Add a z-order value: each column is range-bucketed into 2^bits
    quantile buckets (boundaries from one approx_percentile job, a bounded
    list), and the bucket bits are interleaved with built-in bit expressions."""
    k = len(cols)
    nb = 1 << bits
    accuracy = max(10_000, 4 * nb)
    probs = [i / nb for i in range(1, nb)]
    keys = [f"_zk{i}" for i in range(k)]
    skips = {c: common_prefix_len(df, c) if isinstance(df.schema[c].dataType, StringType) else 0
             for c in cols}
    tmp = df.withColumns({kk: F.coalesce(order_key(df, c, skips[c]), F.lit(-math.inf))
                          for kk, c in zip(keys, cols)})
    qrow = tmp.agg(*[F.percentile_approx(kk, probs, accuracy).alias(kk) for kk in keys]).first()
    bcols = []
    for i, kk in enumerate(keys):
        bounds = sorted({float(q) for q in (qrow[kk] or []) if q is not None and math.isfinite(q)})
        splits = [-math.inf, *bounds, math.inf]
        if len(splits) >= 3:
            tmp = Bucketizer(splits=splits, inputCol=kk, outputCol=f"_zb{i}",
                             handleInvalid="keep").transform(tmp)
        else:  # a single distinct value: one bucket
            tmp = tmp.withColumn(f"_zb{i}", F.lit(0.0))
        bcols.append(F.col(f"_zb{i}").cast("long"))
    z = F.lit(0).cast("long")
    for b in range(bits):
        for i, bc in enumerate(bcols):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(bc, b).bitwiseAND(F.lit(1).cast("long")), b * k + i))
    out = tmp.withColumn(name, z)
    return out.drop(*keys, *[f"_zb{i}" for i in range(k)])


def _quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row, without the columns that Spark does not hash."""
    return F.xxhash64(F.lit(0), *[_quoted(f.name) for f in df.schema.fields
                                  if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))])


def _sort_bytes(df: DataFrame) -> int:
    """About the bytes that all rows take in a sort: 8 for each column, 32 for
    the row and its place, and the length of what has no fixed width."""
    size = F.lit(32 + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(_quoted(f.name)), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType, UserDefinedType, VariantType)):
            size = size + F.coalesce(F.octet_length(_quoted(f.name).cast("string")), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def _ranges(df: DataFrame, files: int | None, range_bytes: int) -> int:
    """``files`` (else the session's shuffle partitions), or more where a range
    of the table would hold over ``range_bytes``."""
    least = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-_sort_bytes(df) // range_bytes))


def _ranged(df: DataFrame, files: int | None, n: int, *by) -> DataFrame:
    """``n`` ranges of ``by``; without ``files``, AQE may join small ones to its advisory size."""
    if not files and n == int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartitionByRange(*by)
    return df.repartitionByRange(n, *by)


def zorder_layout(df: DataFrame, cols: Sequence[str], path: str, files: int | None = None,
                  range_bytes: int = RANGE_BYTES) -> str:
    """Write ``df`` clustered by the z-order of ``cols`` (ZORDER BY): files
    cover compact z ranges, so parquet min/max statistics skip files for
    filters on any of the columns. Rows of one z value are told apart by the
    columns themselves and a hash of the row, so a hot cell is many files.
    ``files`` is the least number of ranges: a table of more than
    ``range_bytes`` for each gets more, so a task's sort does not grow with it."""
    n = _ranges(df, files, range_bytes)
    z = with_zvalue(df, cols, z_bits(n, len(cols))).withColumn("_h", _row_hash(df))
    by = ["_z", *cols, "_h"]
    _ranged(z, files, n, *by).sortWithinPartitions(*by).drop("_z", "_h").write.mode("overwrite").parquet(path)
    return path


def sorted_write(df: DataFrame, cols: Sequence, path: str, files: int | None = None,
                 range_bytes: int = RANGE_BYTES) -> str:
    """Write a table globally ordered by ``cols`` across files (ORDER BY in a
    CTAS): range partitioning + a per-task sort, no single-task sort. A later
    read does not promise this order back. ``files`` is the least number of
    ranges, as in :func:`zorder_layout`; rows equal in ``cols`` may lie in
    several files, told apart by a hash of the row."""
    n = _ranges(df, files, range_bytes)
    _ranged(df, files, n, *cols, _row_hash(df)).sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)
    return path


def partition_profile(df: DataFrame, cols: Sequence[str], ts: str | None = None) -> DataFrame:
    """SHOW PARTITIONS with sizes: rows (and min/max ``ts``) per partition value."""
    aggs = [F.count(F.lit(1)).alias("num_rows")]
    if ts:
        aggs += [F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")]
    return df.groupBy(*cols).agg(*aggs)


def layer_inventory(spark: SparkSession, tables: dict[str, str], layer_of=None) -> DataFrame:
    """One row per stored table: layer, table_name, num_rows, num_columns, the
    newest ``_ingested_at`` when the table has audit columns, and the newest
    data file's modification time (``last_altered``; for a versioned table,
    of its current version's files). Counts run
    as one aggregate per table (parquet footers answer plain counts)."""
    from kilowatt.sinks.layers import read_layer

    parts = []
    for name, path in tables.items():
        t = read_layer(spark, path)  # versioned tables: the latest version
        newest = F.max("_ingested_at") if "_ingested_at" in t.columns else F.lit(None).cast("timestamp")
        layer = layer_of(name) if layer_of else name.split(".")[0]
        parts.append(t.agg(F.count(F.lit(1)).alias("num_rows"), newest.alias("last_ingested_at"),
                           F.max("_metadata.file_modification_time").alias("last_altered"))
                     .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "num_rows",
                             F.lit(len(t.columns)).alias("num_columns"),
                             "last_ingested_at", "last_altered"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
