"""Helpers of the pipeline operators: row wrapping, fold columns, stored
intermediate tables and connected components."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatt.session import scratch_path

#: ASCII white space, as the word and normalisation rules use it.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Python workers started from now on find this package where the driver
    does (a local run, or a folder that all machines have; elsewhere it is
    shipped with --py-files, as any package)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: the lineage
    ends there, so a lost executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over as many partitions as the session shuffles into: for a small
    table before work that grows with each row."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (a null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def wrapped(df: DataFrame) -> DataFrame:
    """All columns of ``df`` inside one struct column ``row``, so that working
    columns beside it cannot clash with the caller's names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unwrapped(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def hex16(col: Column) -> Column:
    """A bigint as 16 lower-case hex digits (its unsigned 64-bit value)."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def _star_step(edges: DataFrame, small: bool, salts: int) -> DataFrame:
    """One large-star or small-star step over edges ``src > dst``.

    The minimum per node is a map-side combined aggregate; it is joined back
    under ``salts`` copies, so a node with very many links is met by many tasks.
    """
    if small:
        sides = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    else:
        sides = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
            edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    low = sides.groupBy("u").agg(F.min("v").alias("low")).select(
        "u", F.least("low", "u").alias("low"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = sides.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(low, ["u", "salt"])
    if small:
        out = met.select(F.col("v").alias("src"), F.col("low").alias("dst")).unionByName(
            low.filter("salt = 0").select(F.col("u").alias("src"), F.col("low").alias("dst")))
    else:
        out = met.filter("v > u").select(F.col("v").alias("src"), F.col("low").alias("dst"))
    return out.filter("src > dst").distinct()


def connected_components(links: DataFrame, salts: int = 4) -> DataFrame:
    """Components of an undirected graph: ``links(a, b)`` bigint → ``(node, root)``,
    one row per node that has a link to another node, root = its smallest member.

    Alternating large-star and small-star steps (a logarithmic number of them),
    each a pair of shuffles over the links; the links of every step are stored,
    and only their number and checksum come to the driver. Links of a node to
    itself and links with a null end are ignored; no links give an empty table.
    """
    edges = links.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).filter(
        "a is not null and b is not null and a <> b").distinct()
    edges = stored(edges, "links")
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("x")).first()
        if now == mark or not now["n"]:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
                edges.select(F.col("dst").alias("node"), F.col("dst").alias("root"))).distinct()
        mark = now
        edges = stored(_star_step(_star_step(edges, False, salts), True, salts), "links")
