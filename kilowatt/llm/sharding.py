"""Sharding over fixed virtual slots.

Records are hashed into thousands of slots, once and for all. Which shard has
which slot is a small table with a version: the first one packs the slots by
their bytes, later ones are edits that move few slots.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilowatt.llm.shared import stored
from kilowatt.session import path_exists, scratch_path

SLOTS = 4096
MAP_SCHEMA = "slot int, shard int, bytes long, version int"
#: Bits of the hash that order the rows of a slot.
_ORDER_BITS = 30


def text_bytes(text: Column) -> Column:
    """Bytes of the text in UTF-8 and one for the record; null: none and one."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``id``, ``size``, ``crc``, ``place``, ``slot`` of every row of ``docs``.

    The slot comes from the id and the text, so rows without an id, or with one
    that repeats, are spread as well. Rows equal in all of it are numbered (they
    are interchangeable, so any numbering gives the same records), inside the
    parts they were stored in and shifted by the counts of the parts before: a
    group of any size is spread over the slots and never met by one task.
    """
    text = F.col(text_col).cast("string")
    rows = stored(docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("size"),
                              F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("crc"),
                              F.xxhash64(F.col(id_col).cast("string"), text).alias("mark"),
                              F.spark_partition_id().alias("part")), "records")
    same, of = ["id", "size", "crc", "mark"], lambda c, side: F.col(f"{side}.{c}")
    counts = rows.groupBy(*same, "part").agg(F.count("*").alias("n"))
    shifts = stored(counts.withColumn("of_all", F.sum("n").over(Window.partitionBy(*same))).filter("of_all > 1").withColumn(
        "shift", F.sum("n").over(Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))), "repeated")
    keys = [*same, "part"]
    again = F.lit(True)
    for c in keys:
        again = again & of(c, "a").eqNullSafe(of(c, "b"))
    joined = rows.alias("a").join(shifts.alias("b"), again, "left").select(*[of(c, "a").alias(c) for c in keys], of("n", "b").alias("n"), F.coalesce(of("shift", "b"), F.lit(0)).alias("shift"))
    single = joined.filter("n is null").withColumn("copy", F.lit(0).cast("long"))
    many = joined.filter("n is not null").withColumn("copy", F.col("shift") + F.row_number().over(
        Window.partitionBy(*keys).orderBy("part")) - 1)
    place = F.xxhash64("mark", "copy", F.lit(11))
    return single.unionByName(many).select("id", "size", "crc", "copy", place.alias("place")).withColumn(
        "slot", F.pmod("place", F.lit(slots)).cast("int"))


def slot_bytes(sized: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes of each slot, on the driver: ``slots`` numbers, however many rows."""
    out = [0] * slots
    for r in sized.groupBy("slot").agg(F.sum("size").alias("bytes")).collect():
        out[r["slot"]] = r["bytes"]
    return out


def first_map(weights: list[int], shards: int) -> list[int]:
    """Shard of each slot: the heaviest slot left goes to the lightest shard;
    slots without bytes are dealt out evenly. Ties go by slot and shard number."""
    load = [(0, 0, s) for s in range(shards)]
    heapq.heapify(load)
    out = [0] * len(weights)
    for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
        total, n, shard = heapq.heappop(load)
        out[slot] = shard
        heapq.heappush(load, (total + weights[slot], n + 1, shard))
    return out


def edited_map(current: list[int], weights: list[int], shards: int, tolerance: float = 0.01) -> list[int]:
    """``current`` edited for new weights or another number of shards.

    Shards from ``shards`` on give up all slots. Then, as long as a shard is
    above the mean by more than ``tolerance``, the heaviest one hands the
    lightest the largest slot that fits into half of their difference, so the
    spread shrinks with every move and few slots move. All others stay put.
    """
    out, load = list(current), [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(current):
        if shard < shards:
            load[shard] += weights[slot]
            held[shard].append((weights[slot], slot))
        else:
            homeless.append((weights[slot], slot))

    def move(weight: int, slot: int, to: int) -> None:
        out[slot] = to
        load[to] += weight
        held[to].append((weight, slot))

    for weight, slot in sorted(homeless, key=lambda x: (-x[0], x[1])):
        move(weight, slot, min(range(shards), key=lambda s: (load[s], s)))
    mean = sum(load) / shards
    full = set()
    while len(full) < shards:
        heavy = max((s for s in range(shards) if s not in full), key=lambda s: (load[s], -s))
        light = min(range(shards), key=lambda s: (load[s], s))
        if load[heavy] <= mean * (1 + tolerance):
            break
        fits = [x for x in held[heavy] if 0 < x[0] <= (load[heavy] - load[light]) / 2]
        if not fits:
            full.add(heavy)
            continue
        best = max(fits, key=lambda x: (x[0], -x[1]))
        held[heavy].remove(best)
        load[heavy] -= best[0]
        move(*best, light)
    return out


def save_map(spark: SparkSession, path: str, version: int, shards_of: list[int], weights: list[int]) -> None:
    """Version ``version`` of the slot map under ``path``: one small file that
    appears whole or not at all. A version is never written twice."""
    rows = [(slot, shard, weights[slot], version) for slot, shard in enumerate(shards_of)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{path}/v{version:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The slot map of a version: ``slot``, ``shard``, ``bytes``, ``version``.
    A version that was never saved, or not to its end, is an error."""
    folder = f"{path}/v{version:06d}"
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        raise ValueError(f"no version {version} of the slot map at {path}")
    return spark.read.schema(MAP_SCHEMA).parquet(folder)


def rebalance(spark: SparkSession, path: str, version: int, sized: DataFrame, shards: int, tolerance: float = 0.01) -> int:
    """Measures ``sized(slot, size)`` under the map of ``version`` and stores the
    edited map as the next version, which is returned. Only the rows of slots
    that change their shard have to move."""
    current = [0] * load_map(spark, path, version).count()
    for r in load_map(spark, path, version).collect():
        current[r["slot"]] = r["shard"]
    weights = slot_bytes(sized, len(current))
    save_map(spark, path, version + 1, edited_map(current, weights, shards, tolerance), weights)
    return version + 1


def moved(spark: SparkSession, path: str, before: int, after: int) -> DataFrame:
    """Slots whose shard differs between two versions: ``slot``, ``shard_before``,
    ``shard_after``, ``bytes``."""
    a, b = load_map(spark, path, before), load_map(spark, path, after)
    return a.select("slot", F.col("shard").alias("shard_before")).join(
        b.select("slot", F.col("shard").alias("shard_after"), "bytes"), "slot").filter("shard_before <> shard_after")


def positions(sized: DataFrame, slot_map: DataFrame, rows_per_part: int = 100_000) -> DataFrame:
    """``sized`` with its ``shard`` and ``position``: rows of a shard numbered from
    0 without gaps, by slot and, within a slot, by the records' hash.

    Slots are cut into parts of about ``rows_per_part`` rows by leading bits of
    the hash that orders them; each part is numbered by a task of its own and
    shifted by the counts of the parts before, so no shard or slot is ever one
    group, and the numbers do not depend on how finely slots are cut.
    """
    spread = F.shiftrightunsigned("place", 64 - _ORDER_BITS)
    total = sized.count()
    slots = slot_map.count()
    parts = 1
    while parts < 1 << 16 and total > slots * parts * rows_per_part:
        parts *= 2
    cut = F.shiftrightunsigned("place", 64 - parts.bit_length() + 1).cast("long") if parts > 1 else F.lit(0).cast("long")
    rows = sized.join(F.broadcast(slot_map.select("slot", "shard")), "slot").withColumn("cut", cut)
    counts = rows.groupBy("shard", "slot", "cut").agg(F.count("*").alias("n"))
    shifts = counts.withColumn("shift", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("slot", "cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    number = F.row_number().over(Window.partitionBy("shard", "slot", "cut").orderBy(spread, "place", "id", "size", "crc", "copy")) - 1
    return rows.withColumn("number", number).join(shifts, ["shard", "slot", "cut"]).withColumn(
        "position", F.col("number") + F.col("shift")).drop("number", "shift", "cut")


def shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
           path: str | None = None, rows_per_part: int = 100_000) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``size`` (bytes of the text plus
    one), ``text_crc32``, ``shard``, ``slot`` (its place in the shard, from 0
    without gaps), ``virtual_slot``, ``map_version``.

    Bytes are summed per virtual slot, the slots are packed into ``n_shards``
    shards of nearly equal bytes, and the map is stored as version 1 under
    ``path`` (unset: the shared scratch folder). Null text: size 1, checksum 0.
    Null or repeated ids: spread by their texts. Repeated rows: rows of their own.
    The same rows give the same result, however they are partitioned. No rows:
    an even map and an empty result. Other columns are ignored. One row larger
    than a shard's share leaves its shard that much larger.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "slot-map")
    sized = stored(records(docs, id_col, text_col, slots), "sized")
    weights = slot_bytes(sized, slots)
    save_map(spark, path, 1, first_map(weights, n_shards), weights)
    placed = positions(sized, load_map(spark, path, 1), rows_per_part)
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                         F.col("position").cast("long").alias("slot"), F.col("slot").alias("virtual_slot"), F.lit(1).alias("map_version"))
