"""Ranking: partitioned rank windows, and ranks that no single task computes.

``Window.orderBy(...)`` without ``partitionBy`` moves the whole table into one
task, and a window per group moves a hot group into one. The distributed form
gives the same dense_rank / rank / row_number with one shuffle of the rows:

1. rows are range-partitioned by (group, order value, tie-break columns) with
   Spark's own ordering, so any type works and neither a hot group nor a hot
   value stays together, and sorted within the ranges;
2. the same task passes over its sorted rows once, carrying counters from batch
   to batch, and ranks them within the range; the result is written;
3. only groups that go on from one range into the next need more. The rows at
   the edges of the ranges (four of each at most) give their counts, first and
   last values; a running sum over the ranges of a group gives the offsets of a
   range's first group. That table has a row per range and is broadcast. A value
   that goes on from the range before keeps the rank with which it began there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowatt.session import stored

RANK_COLUMNS = ("dense_rank", "rank", "row_number")


def _order(order: str, descending: bool) -> Column:
    """NULLs last descending, first ascending (Spark's defaults)."""
    return F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()


def rank_within(df: DataFrame, partition: Sequence[str], order: str, descending: bool = True,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """dense_rank, rank and row_number side by side over one window spec
    (one shuffle, one sort); a group is ranked by one task."""
    w = Window.partitionBy(*partition).orderBy(_order(order, descending))
    w_rn = Window.partitionBy(*partition).orderBy(_order(order, descending), *[F.col(c).asc() for c in tiebreak])
    return df.withColumns({"dense_rank": F.dense_rank().over(w).cast("bigint"),
                           "rank": F.rank().over(w).cast("bigint"),
                           "row_number": F.row_number().over(w_rn).cast("bigint")})


_LOCAL = "_n long, _r long, _d long, _edge byte"
#: Marks of a range's rows: in its first group; at the start of the range, at the end of its first group, at its end.
_FIRST, _START, _TURN, _END = 1, 2, 4, 8


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether a value differs from the one before it, from the second on. NULL
    equals NULL, and NaN equals NaN, as in Spark's ordering."""
    a, b = column.slice(1), column.slice(0, max(0, len(column) - 1))
    try:
        same = pc.fill_null(pc.equal(a, b), False)
        if pa.types.is_floating(column.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    except pa.ArrowNotImplementedError:  # arrays and structs: value by value
        x, y = a.to_pylist(), b.to_pylist()
        same = pa.chunked_array([pa.array([p is not None and p == q for p, q in zip(x, y)], pa.bool_())])
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    return ~pc.or_(same, both_null).to_numpy(zero_copy_only=False).astype(bool) if len(a) else np.zeros(0, bool)


def _rank_pass(batches: Iterator[pa.RecordBatch], group: Sequence[str], order: str) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range → the same with their number, rank and dense rank
    within (range, group) and their marks. A batch waits for the next one, which
    tells whether its last row ends a group or the range."""
    held: tuple[pa.RecordBatch, list[np.ndarray]] | None = None
    n = r = d = 0  # counters of the last row seen
    in_first = True
    before: pa.Table | None = None

    def flushed(batch: pa.RecordBatch, marks: list[np.ndarray]) -> pa.RecordBatch:
        arrays = [*batch.columns, *[pa.array(x, pa.int64()) for x in marks[:3]], pa.array(marks[3].astype(np.int8), pa.int8())]
        return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "_n", "_r", "_d", "_edge"])

    for b in batches:
        m = b.num_rows
        if not m:
            continue
        keys = pa.Table.from_batches([b.select([*group, order])])
        both = keys if before is None else pa.concat_tables([before, keys])
        new_group = np.zeros(len(both) - 1, bool)
        for c in range(len(group)):
            new_group |= _changes(both.column(c))
        new_value = new_group | _changes(both.column(len(group)))
        if before is None:
            new_group, new_value = np.append(True, new_group), np.append(True, new_value)
        at = np.arange(m)
        g = np.maximum.accumulate(np.where(new_group, at, -1))
        v = np.maximum.accumulate(np.where(new_value, at, -1))
        number = np.where(g >= 0, at - g + 1, n + at + 1)
        rank = np.where(v >= 0, number[v], r)
        values = np.cumsum(new_value)
        dense = np.where(g >= 0, values - values[g] + 1, d + values)
        edge = np.zeros(m, np.int64)
        if before is None:
            edge[0] |= _START
            turns = np.flatnonzero(new_group[1:]) + 1
        else:
            turns = np.flatnonzero(new_group)
        if in_first:
            edge[:turns[0] if len(turns) else m] |= _FIRST
            if len(turns):
                in_first = False
                if turns[0]:
                    edge[turns[0] - 1] |= _TURN
                else:
                    held[1][3][-1] |= _TURN
        if held is not None:
            yield flushed(*held)
        held = (b, [number, rank, dense, edge])
        n, r, d = int(number[-1]), int(rank[-1]), int(dense[-1])
        before = keys.slice(m - 1)
    if held is not None:
        held[1][3][-1] |= _END
        yield flushed(*held)


def in_ranges(df: DataFrame, partition: Sequence[str], order: str, descending: bool = True,
              tiebreak: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``df`` dealt into ``ranges`` (default: the session's shuffle partitions) of
    (group, value, tie-break) and written, with the range number ``_part`` and
    the ranks within (range, group): ``_n``, ``_r``, ``_d``, and the marks ``_edge``."""
    by = [*[F.col(c).asc() for c in partition], _order(order, descending), *[F.col(c).asc() for c in tiebreak]]
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema], _LOCAL])
    group = list(partition)
    return stored(dealt.mapInArrow(lambda batches: _rank_pass(batches, group, order), schema), "ranges")


def bucketed_rank(df: DataFrame, partition: Sequence[str], order: str, descending: bool = True,
                  tiebreak: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """dense_rank / rank / row_number within ``partition`` groups (none: over the
    whole table) that stays balanced when one group, or one value, holds a
    large share of the rows. ``tiebreak`` orders equal values and lets them be
    split; without it they stay in one range."""
    local = in_ranges(df, partition, order, descending, tiebreak, ranges)
    value = F.struct(F.col(order))
    edges = local.filter(F.col("_edge").bitwiseAND(F.lit(_START | _TURN | _END)) != 0).withColumn(
        "_group", F.struct(*partition) if partition else F.lit(0))
    # first and last group of each range: at most three rows a range, whatever the table
    stats = edges.select("_part", "_group", order, "_n", "_r", "_d", "_edge").repartition(1).groupBy("_part", "_group").agg(
        F.max("_n").alias("_n"), F.max("_d").alias("_d"), F.max("_r").alias("_r"),
        F.min_by(value, "_n").alias("_first"), F.max_by(value, "_n").alias("_last"), F.max(F.col("_edge").bitwiseAND(F.lit(_FIRST))).alias("_is_first"))
    w = Window.partitionBy("_group").orderBy("_part")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.lag("_last").over(w) == F.col("_first"), F.lit(False))
    offsets = (stats.withColumn("_goes_on", goes_on)
               .withColumn("_rows", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .withColumn("_values", F.coalesce(F.sum(F.col("_d") - F.col("_goes_on").cast("int")).over(before), F.lit(0))
                           - F.col("_goes_on").cast("int"))
               .withColumn("_began", F.when((F.col("_d") > 1) | ~F.col("_goes_on"), F.col("_rows") + F.col("_r")))
               .withColumn("_began", F.last("_began", ignorenulls=True).over(before))
               .filter("_is_first = 1 and _rows > 0")
               .select(F.col("_part").alias("_of"), "_goes_on", "_rows", "_values", "_began"))
    # at most a row per range
    out = local.join(F.broadcast(offsets), (F.col("_part") == F.col("_of")) & (F.col("_edge").bitwiseAND(F.lit(_FIRST)) != 0), "left")
    rows, values = F.coalesce("_rows", F.lit(0)), F.coalesce("_values", F.lit(0))
    return out.withColumns({
        "rank": F.when((F.col("_r") == 1) & F.col("_goes_on"), F.col("_began")).otherwise(F.col("_r") + rows).cast("bigint"),
        "dense_rank": (F.col("_d") + values).cast("bigint"),
        "row_number": (F.col("_n") + rows).cast("bigint"),
    }).select(*df.columns, *RANK_COLUMNS)


def global_rank(df: DataFrame, order: str, descending: bool = True, tiebreak: Sequence[str] = (),
                ranges: int | None = None) -> DataFrame:
    """Whole-table dense_rank / rank / row_number by ``order`` without a
    single-partition window over the rows."""
    return bucketed_rank(df, (), order, descending, tiebreak, ranges)
