"""Near-duplicate vectors by lattice hashing: random projections decoded to E8
lattice points in several tables, neighbouring cells probed, cosine verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatt.llm.shared import connected_components, stored


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, by their rule: two entries of ±1, or all
    entries ±1/2 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a, b in product((1, -1), repeat=2):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(out)


_AROUND = shortest_vectors()


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest point with whole entries of even sum: round, and where the sum
    is odd, round the entry with the largest error the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(x - near)[odd].argmax(1)
    near[odd, worst] += np.where(x[odd, worst] > near[odd, worst], 1, -1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the nearer of those with whole and with
    half entries."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def cells(unit: np.ndarray, tables: int, probes: int, width: float, seed: int) -> np.ndarray:
    """Cell numbers (rows × tables·probes) of unit vectors: in each table the
    cell of the vector's projection and its ``probes - 1`` nearest neighbours."""
    rng = np.random.default_rng(seed)
    weights = rng.integers(1, 1 << 62, size=(tables, 8), dtype=np.int64).astype(np.uint64) | np.uint64(1)
    out = []
    for t in range(tables):
        x = unit @ rng.normal(0, 1 / width, (unit.shape[1], 8))
        home = decode_e8(x)
        reach = ((x - home)[:, None, :] - _AROUND[None]) ** 2
        near = np.argsort(reach.sum(2), axis=1, kind="stable")[:, :probes - 1]
        points = np.concatenate([home[:, None, :], home[:, None, :] + _AROUND[near]], axis=1)
        codes = ((2 * points).astype(np.int64).astype(np.uint64) * weights[t]).sum(2, dtype=np.uint64)
        codes ^= codes >> np.uint64(31)
        out.append(codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t))
    return np.concatenate(out, axis=1).view(np.int64)


def _hashed(rows: DataFrame, tables: int, probes: int, width: float, seed: int) -> DataFrame:
    """``rows(label, vector, key)`` with unit vectors (binary doubles) and cells;
    vectors of several lengths are hashed by length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, key, vectors = b.column(0), b.column(1), b.column(2)
            lengths = np.array([len(v) for v in vectors])
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                x = np.array([vectors[int(i)].as_py() for i in at], np.float64)
                x /= np.abs(x).max(1, keepdims=True)  # neither overflow nor underflow in the norm
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                for part in np.array_split(np.arange(len(at)), -(-len(at) // 512)):
                    found = cells(x[part], tables, probes, width, seed + int(n))
                    pick = pa.array(at[part])
                    yield pa.RecordBatch.from_arrays([label.take(pick), key.take(pick), pa.array([v.tobytes() for v in x[part]], pa.binary()),
                                                      pa.array(found.tolist(), pa.list_(pa.int64()))], names=["label", "key", "unit", "cells"])

    kind = dict(rows.dtypes)["label"]
    return rows.select("label", "key", "vector").mapInArrow(run, f"label {kind}, key bigint, unit binary, cells array<bigint>")


def _pairs(unit: np.ndarray, mine: np.ndarray, side: np.ndarray, here: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (positions) of the rows of one meeting, in order of their keys, whose
    cosine is at least ``least`` and whose first common cell is ``here``.
    ``mine``: rows × tables × cells of a table."""
    first, second = [np.zeros(0, int)], [np.zeros(0, int)]
    for begin in range(0, len(unit), 512):
        a, b = np.nonzero(unit[begin:begin + 512] @ unit.T >= least)
        a += begin
        ok = (a < b) & ((side[a] != side[b]) | (side[a] == 0))
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 50_000):
            x, y = a[at:at + 50_000], b[at:at + 50_000]
            both = (mine[x][:, :, :, None] == mine[y][:, :, None, :]).any(3).reshape(len(x), -1)
            keep = mine[x].reshape(len(x), -1)[np.arange(len(x)), both.argmax(1)] == here
            first.append(x[keep])
            second.append(y[keep])
    return np.concatenate(first), np.concatenate(second)


def _meetings(batches: Iterator[pa.RecordBatch], tables: int, least: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (label, cell, i, j, key) → per meeting and vertex with a
    link: ``key``, ``root`` (a vertex it is connected to, the same for all of a
    cluster), ``links``. Meetings are small (two parts of a cell at most) and
    are worked on one after the other, so a task holds a batch and one meeting."""
    def meet(t: pa.Table) -> pa.RecordBatch | None:
        unit = [np.frombuffer(u, np.float64) for u in t["unit"].to_pylist()]
        key, n, side = (t[c].to_numpy() for c in ("key", "n", "side"))
        mine = np.array(t["cells"].to_pylist(), np.int64).reshape(len(key), tables, -1)
        here = t["cell"][0].as_py()
        lengths = np.array([len(u) for u in unit])
        found = []
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            x, y = _pairs(np.array([unit[i] for i in at]), mine[at], side[at], here, least)
            found.append((at[x], at[y]))
        a, b = (np.concatenate(x) for x in zip(*found))
        if not len(a):
            return None
        links = np.bincount(a, n[b], len(key)) + np.bincount(b, n[a], len(key))
        root = np.arange(len(key))
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, before[a], low)
            np.minimum.at(root, before[b], low)
            root = root[root]
            if np.array_equal(before, root):
                break
        some = links > 0
        return pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(key[root[some]]), pa.array(links[some].astype(np.int64))],
                                          names=["key", "root", "links"])

    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b]).combine_chunks()
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        new = np.zeros(t.num_rows - 1, bool)
        for c in ("label", "cell", "i", "j"):
            new |= pc.not_equal(t[c].slice(1), t[c].slice(0, t.num_rows - 1)).to_numpy()
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for i, j in zip(cuts, cuts[1:]):
            if j - i > 1 and (out := meet(t.slice(i, j - i))) is not None:
                yield out
        rest = t.slice(cuts[-1])
    if rest is not None and rest.num_rows > 1 and (out := meet(rest)) is not None:
        yield out


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = 0.98, tables: int = 4, probes: int = 4, width: float = 0.9, cell_rows: int = 256, seed: int = 5) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, ``n_links``, ``component_id``,
    ``kept``.

    Equal vectors of a label are one vertex with a count. A vertex is put into
    its own and its nearest lattice cells of every table; the vertices of a cell
    meet, and pairs with a cosine of at least ``least`` are counted in the first
    cell that they share, so never twice. A task returns counts and a spanning
    set of links, not the pairs. A cell of more than ``cell_rows`` vertices is
    dealt into parts, and every two parts meet in a task of their own.

    Rows whose vector or label is null, or whose vector is zero, empty or holds
    a null or non-finite entry, link with nothing. Repeated rows are vectors of
    their own: they link with each other. A row without id counts as a vector;
    its component is the smallest id reachable, or null.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    rows = stored(rows.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("vector", F.when(F.col("usable"), F.transform("vector", lambda v: v + F.lit(0.0)))),
                  "vectors")
    groups = rows.filter("usable").groupBy("label", "vector").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    groups = stored(groups.withColumn("key", F.xxhash64("label", "vector")), "vertices")
    hashed = stored(_hashed(groups, tables, probes, width, seed).join(groups.select("key", "n"), "key"), "cells")

    spread = hashed.select("label", "key", F.explode(F.array_distinct("cells")).alias("cell"))
    sizes = spread.groupBy("label", "cell").count().filter("count > 1")
    full = spread.join(sizes, ["label", "cell"]).withColumn("parts", F.ceil(F.col("count") / cell_rows).cast("int"))
    full = full.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # side 0: both rows are of the same part; 1 and 2: rows of two parts meet
    full = full.select("key", "label", "cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                       F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side"))
    full = full.join(hashed.select("key", "unit", "cells", "n"), "key")

    order = ["label", "cell", "i", "j"]
    dealt = full.select(*order, "key", "side", "n", "unit", "cells").repartition(*order).sortWithinPartitions(*order, "key")
    met = stored(dealt.mapInArrow(lambda b: _meetings(b, tables, least), "key bigint, root bigint, links bigint"), "met")
    degree = met.groupBy("key").agg(F.sum("links").alias("links"))
    parts = connected_components(met.select(F.col("key").alias("a"), F.col("root").alias("b")))
    linked = stored(parts.join(groups.select("key", "low"), F.col("node") == F.col("key")).select("key", "root", "low"), "linked")
    lowest = linked.groupBy("root").agg(F.min("low").alias("component"))
    named = linked.join(lowest, "root").select(F.col("key"), "component")
    table = groups.join(degree, "key", "left").join(named, "key", "left").select(
        F.col("key").alias("k"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "low").alias("component"))
    table = stored(table, "classes")
    out = rows.withColumn("key", F.when(F.col("usable"), F.xxhash64("label", "vector"))).join(table, F.col("key") == F.col("k"), "left")
    component = F.when(F.col("usable"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
