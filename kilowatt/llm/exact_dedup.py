"""Exact duplicates: 128-bit content hash, bytes compared, smallest id stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatt.llm.shared import SPACES, unwrapped, wrapped


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash=F.md5) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` (of the normalised text).

    Texts are grouped by ``content_hash`` (128 bits) *and* their bytes: the hash
    spreads the groups over tasks, the aggregate's own key comparison keeps
    texts apart that only share a hash. Copies are combined on the map side, so
    a group of any size sends one row per task. Every row then finds its group
    by hash and SHA-256; that join carries no text, and a hot group's rows can
    be split by skew handling because both sides are shuffled for it.

    Null text: equal to the empty text. Null id: such a row is never smaller
    than a row with an id; a group of null ids only has a null ``keep_id`` and
    keeps its rows. Rows that repeat an id are one document: they get the same
    decision. Empty input: empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm")).withColumn(
        "hash", content_hash("norm"))
    groups = rows.groupBy("hash", "norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.select("hash", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    return rows.select("id", "hash", F.sha2("norm", 256).alias("sha")).join(groups, ["hash", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose normalised text a row with a smaller id
    has; all columns and values stay as they are.

    Only the rows to drop (id and SHA-256) are joined, as an anti join; a row
    that repeats a kept id with the same text stays.
    """
    gone = exact_groups(docs, id_col, text_col).filter("not kept").select(
        F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_sha")).distinct()
    rows = wrapped(docs).withColumn("sha", F.sha2(normalised(F.col(f"row.`{text_col}`")), 256))
    return unwrapped(rows.join(gone, F.col(f"row.`{id_col}`").eqNullSafe(F.col("gone_id"))
                               & (F.col("sha") == F.col("gone_sha")), "left_anti"))
