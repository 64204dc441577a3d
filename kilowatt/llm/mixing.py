"""Mixing sources to target weights: capped water-filling, then seeded whole
and fractional repetitions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilowatt.llm.shared import WORDS, stored, unwrapped, wrapped


def words(text: Column) -> Column:
    """Number of words (runs without ASCII white space); null: 0."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def _ordered(sources: DataFrame) -> DataFrame:
    """``position`` of each source by code point, null last, from 0: ranges of
    sources are numbered one by one and shifted by the counts before them."""
    order = F.col("source").asc_nulls_last()
    spread = stored(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before, shift = 0, []
    for r in spread.groupBy("part").count().orderBy("part").collect():
        shift.append((r["part"], before))
        before += r["count"]
    shifts = spread.sparkSession.createDataFrame(shift, "part int, shift long")
    number = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return spread.withColumn("number", number).join(shifts, "part").withColumn(
        "position", F.col("number") + F.col("shift")).drop("part", "number", "shift")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``sized(source, size)`` → one row per source: ``source``, ``source_size``,
    ``n_docs``, ``weight``, ``target``.

    The targets share the sum of all sizes by weight. A source whose share is
    above ``max_epochs`` times its size is clamped there, and what it leaves is
    shared again by weight among the others, until none is above: water-filling
    to one level, found by repeated aggregates of one row. A source without
    words has the target 0. No rows: no sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    table = _ordered(sources).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                               (F.col("position") % len(weights) + 1).cast("int")))
    table = stored(table.withColumn("cap", F.col("source_size") * max_epochs).drop("position"), "weights")
    first = table.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("weight")).first()
    total, level, clamped = first["all"] or 0, None, -1
    level = total / first["weight"] if first["weight"] else 0.0
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("cap")
        now = table.agg(F.sum(F.when(above, F.col("cap")).otherwise(0)).alias("cap"),
                        F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
                        F.count_if(above).alias("n")).first()
        if now["n"] == clamped or not now["weight"]:
            break
        clamped, level = now["n"], (total - now["cap"]) / now["weight"]
    return table.withColumn("target", F.when(above, F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.lit(float(level)))).drop("cap")


def block_of(seed: int, block: int) -> Column:
    """Block of a row among those of its source, by its id, size and text: rows
    that have no id or repeat one are dealt as well."""
    return F.pmod(F.xxhash64("id", "size", "mark", F.lit(seed)), F.ceil(F.col("n_docs") / block))


def allocate(sized: DataFrame, targets: DataFrame, seed: int = 7, block: int = 128) -> DataFrame:
    """How often each row is taken: ``sized(id, source, size, mark, …)``,
    ``mark`` a hash of the text, gives these without the mark and with
    ``source_size``, ``target``, ``whole`` (whole repetitions), ``extra`` (words
    of one fractional repetition), ``taken``.

    Every row is taken ``floor(target / source_size)`` times. The rest of the
    target is sampled: rows are dealt by a seeded hash into blocks of about
    ``block`` rows, and inside a block, in a second seeded order, rows are taken
    once more until the block's share is reached; the last one gives only the
    words that are missing. So no source is ever one group (but copies of one
    row with one id share a block), and a source's
    total is exact but for one word of rounding a block. The same seed and rows
    give the same result, however they are partitioned.
    """
    t = targets.select(F.col("source").alias("t_source"), "source_size", "n_docs", "target")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sized.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = rows.withColumn("whole", F.floor(epochs).cast("long")).withColumn("part", epochs - F.col("whole")).withColumn(
        "block", block_of(seed, block))
    group = Window.partitionBy("source", "block")
    order = group.orderBy(F.xxhash64("id", F.lit(seed + 1)), "id", "size", "mark").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    quota = F.round(F.col("part") * F.col("block_size")).cast("long")
    rows = rows.withColumn("until", F.sum("size").over(order)).withColumn("block_size", F.sum("size").over(group))
    rows = rows.withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least(
        F.col("size"), quota - F.col("until") + F.col("size"))))
    return rows.withColumn("taken", F.col("whole") * F.col("size") + F.col("extra")).drop(
        "n_docs", "part", "block", "until", "block_size", "mark")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """One row per document: ``id_col``, ``size``, ``source_size``, ``target``,
    ``taken``, ``whole``, ``extra``. Texts are read once; what follows works on
    ids and sizes. Null text: size 0. Null source: a source of its own, last.
    Repeated rows are rows of their own. Other columns are ignored."""
    sized = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               words(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("mark")), "sizes")
    return allocate(sized, source_targets(sized, weights, max_epochs), seed).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken", "whole", "extra")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan says, all its
    columns unchanged; a fractional repetition holds the first ``extra`` words
    of the text, joined by single spaces. Rows without words are
    never repeated: they stay once where their source is taken once or more."""
    rows = wrapped(docs).select("row", F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{source_col}`").alias("source"),
                                words(F.col(f"row.`{text_col}`")).alias("size"), F.xxhash64(F.col(f"row.`{text_col}`")).alias("mark"))
    sized = stored(rows.select("source", "size"), "sizes")
    plan = allocate(rows, source_targets(sized, weights, max_epochs), seed)
    whole = F.when(F.col("size") > 0, F.col("whole")).otherwise(F.least(F.col("whole"), F.lit(1).cast("long")))
    complete = whole + F.when((F.col("extra") > 0) & (F.col("extra") == F.col("size")), 1).otherwise(0)
    cut = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    text = F.col(f"row.`{text_col}`")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), F.lit(1), F.col("extra").cast("int")), " ")
    copies = F.concat(F.array_repeat(F.lit(False), complete.cast("int")),
                      F.array_repeat(F.lit(True), F.when(cut, 1).otherwise(0)))
    out = plan.select("row", "extra", F.explode(copies).alias("is_part"))
    return unwrapped(out.select(F.when(F.col("is_part"), F.col("row").withField(f"`{text_col}`", head)).otherwise(
        F.col("row")).alias("row")))
