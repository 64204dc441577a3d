"""SimHash near-duplicates: 64-bit fingerprints, linked by a binary trie
self-join within a Hamming budget."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatt.llm.shared import connected_components, hex16, stored, unwrapped, wrapped

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Shingles hashed at a time: bounds the memory a long text takes.
_SLICE = 65_536
#: Node pairs the traversal holds at a time.
_PAIRS = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text (unsigned); 0 for a text without words."""
    found = (m.group() for m in _WORD.finditer((text or "").translate(_LOWER)))
    words = list(islice(found, shingle - 1))
    ones, total = np.zeros(64, np.int64), 0
    while True:
        more = list(islice(found, _SLICE))
        words += more
        if not more and total:
            break
        if len(words) >= shingle:
            parts = [" ".join(w) for w in zip(*(words[i:] for i in range(shingle)))]
        else:
            parts = [" ".join(words)] if words else []
        if not parts:
            break
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, [seed] * len(parts)), np.uint64, len(parts))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(parts)
        if len(words) < shingle:
            break
        words = words[len(words) - shingle + 1:] if shingle > 1 else []
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """``(id, fingerprint bigint)`` per row of ``docs``, over whole texts.

    A-Z are lower-cased, words are runs without ASCII white space, shingles of
    ``shingle`` words (repeats counted) are joined by one space and hashed with
    XXH64; a bit is 1 if it is set in over half of the hashes. Fewer words than
    a shingle: the whole sequence is the one shingle. No word or null: 0.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.fromiter((simhash(t.as_py(), shingle, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(hashed, f"id {kind}, fingerprint bigint")


def trie_links(prints: np.ndarray, starts: np.ndarray, max_bits: int, pairs: int = _PAIRS) -> np.ndarray:
    """Self-join of many binary tries at once → for each position the smallest
    position of its component (links join fingerprints of one trie only).

    ``prints`` (uint64) holds the tries one after the other, each from
    ``starts[k]`` on, ascending and without repeats. A node is a range of
    positions that share their leading bits; a pair of nodes carries the number
    of bits in which the two prefixes differ. All pairs go down one bit
    together: equal branches keep the count, unequal ones add one, pairs above
    ``max_bits`` are dropped, and a pair of single fingerprints adds what is left
    of their difference at once. Pairs wait on a stack in blocks, deepest
    first, so the memory stays bounded.
    """
    n = len(prints)
    root = np.arange(n)
    ends = np.append(starts[1:], n)
    ones: dict[int, np.ndarray] = {}
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        """Lets ``root`` follow the links found so far."""
        nonlocal root
        a, b = (np.concatenate(x) for x in zip(*found))
        found.clear()
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, before[a], low)
            np.minimum.at(root, before[b], low)
            root = root[root]
            if np.array_equal(before, root):
                return

    big = ends - starts > 1
    stack = [(63, starts[big], ends[big], starts[big], ends[big], np.zeros(int(big.sum()), np.int64))]
    while stack:
        bit, la, ha, lb, hb, err = stack.pop()
        if len(la) > pairs:
            half = len(la) // 2
            stack += [(bit, *(x[half:] for x in (la, ha, lb, hb, err))), (bit, *(x[:half] for x in (la, ha, lb, hb, err)))]
            continue
        single = (ha - la == 1) & (hb - lb == 1)
        if single.any():
            a, b = la[single], lb[single]
            near = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
            found.append((a[near], b[near]))
            if sum(len(x[0]) for x in found) > pairs:
                settle()
            la, ha, lb, hb, err = (x[~single] for x in (la, ha, lb, hb, err))
        if not len(la):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((prints >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        count = ones[bit]
        ma, mb = ha - (count[ha] - count[la]), hb - (count[hb] - count[lb])
        other = la != lb
        new = [np.concatenate(x) for x in zip(
            (la, ma, lb, mb, err), (ma, ha, mb, hb, err), (la, ma, mb, hb, err + 1),
            (ma[other], ha[other], lb[other], mb[other], err[other] + 1))]
        la, ha, lb, hb, err = new
        alive = (ha > la) & (hb > lb) & (err <= max_bits) & ~((la == lb) & (ha - la == 1))
        if alive.any():
            stack.append((bit - 1, *(x[alive] for x in new)))
    if found:
        settle()
    return root


def _links(batches: Iterator[pa.RecordBatch], max_bits: int, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, fingerprint)`` sorted by both → links of each fingerprint to
    the first of its component, a key at a time but many keys together."""
    def flush(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        # ascending as unsigned within a key; signed order only swaps the halves
        order = np.lexsort((prints.view(np.uint64), np.cumsum(np.append(0, keys[1:] != keys[:-1]))))
        prints = prints[order]
        root = trie_links(prints.view(np.uint64), starts, max_bits)
        linked = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays([pa.array(prints[linked]), pa.array(prints[root[linked]])], names=["a", "b"])

    kept: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for b in batches:
        if not b.num_rows:
            continue
        kept.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)))
        held += b.num_rows
        if held >= rows:
            keys, prints = (np.concatenate(x) for x in zip(*kept))
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield flush(keys[:last], prints[:last])
            kept, held = [(keys[last:], prints[last:])], len(keys) - last
    if held:
        yield flush(*(np.concatenate(x) for x in zip(*kept)))


def near_links(prints: DataFrame, max_bits: int = 3, node_rows: int = 4096) -> DataFrame:
    """Distinct ``prints(fingerprint)`` → links ``(a, b)`` whose components are
    those of all pairs that differ in at most ``max_bits`` bits.

    Two fingerprints within the budget agree on at least one of
    ``max_bits + 1`` runs of bits, so each fingerprint goes, once per run, to
    the trie of the fingerprints with its value there. A trie with more than
    ``node_rows`` fingerprints is dealt again by the runs of the remaining bits,
    which must agree in one as well; where even that leaves more, the
    fingerprints are dealt into parts and every two parts meet in a task of
    their own. Nothing is left out at any step.
    """
    runs = max_bits + 1
    width = 64 // runs
    second = (64 - width) // runs

    def cut(at: int, bits: int):
        return F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << bits) - 1))

    first = prints.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(k).alias("run"), cut(k * width, width if k < max_bits else 64 - k * width).alias("value"))
        for k in range(runs)])).alias("n")).select("fingerprint", "n.run", "n.value")
    sizes = stored(first.groupBy("run", "value").count().filter("count > 1"), "nodes")
    first = first.join(sizes, ["run", "value"])
    small = first.filter(F.col("count") <= node_rows).select(F.xxhash64("run", "value").alias("key"), "fingerprint")

    hot = first.filter(F.col("count") > node_rows)
    cuts = []
    for k in range(runs):
        rest = [p for p in range(64) if not k * width <= p < (64 if k == max_bits else (k + 1) * width)]
        parts = [rest[j * second:(j + 1) * second if j < max_bits else len(rest)] for j in range(runs)]
        cuts.append(F.array(*[F.struct(F.lit(j).alias("run2"), _bits(p).alias("value2")) for j, p in enumerate(parts)]))
    again = hot.select("fingerprint", "run", "value", F.explode(F.element_at(F.array(*cuts), F.col("run") + 1)).alias("n")).select(
        "fingerprint", "run", "value", "n.run2", "n.value2")
    keys = ["run", "value", "run2", "value2"]
    sizes2 = stored(again.groupBy(*keys).count().filter("count > 1"), "nodes2")
    again = again.join(sizes2, keys).withColumn("parts", F.ceil(F.col("count") / node_rows).cast("int"))
    again = again.withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    again = again.select(F.xxhash64(*keys, F.least("part", "other"), F.greatest("part", "other")).alias("key"), "fingerprint")

    dealt = small.unionByName(again).repartition("key").sortWithinPartitions("key", "fingerprint")
    return dealt.mapInArrow(lambda batches: _links(batches, max_bits), "a bigint, b bigint")


def _bits(positions: list[int]):
    """The bits of the fingerprint at ``positions`` (at most two runs), as one number."""
    mask = sum(1 << p for p in positions)
    return F.col("fingerprint").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (bigint),
    ``component_id`` (smallest id reachable over links, itself included).

    Equal fingerprints are one vertex, so copies never become pairs. Texts
    without words (null, empty, white space) have the fingerprint 0 and are
    linked like any other. Null ids are ignored as smallest id. Repeated rows
    share their fingerprint and component. Empty input: empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, seed), "prints")
    lowest = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("low")), "lowest")
    parts = connected_components(near_links(lowest.select("fingerprint"), max_bits))
    linked = stored(parts.join(lowest, F.col("node") == F.col("fingerprint")).select("fingerprint", "root", "low"), "linked")
    roots = linked.groupBy("root").agg(F.min("low").alias("component"))
    named = linked.join(roots, "root").select(F.col("fingerprint").alias("print"), "component")
    named = stored(lowest.join(named, F.col("fingerprint") == F.col("print"), "left").select(
        F.col("fingerprint").alias("print"), F.coalesce("component", "low").alias("component_id")), "components")
    return prints.join(named, F.col("fingerprint") == F.col("print")).select(
        F.col("id").alias(id_col), "fingerprint", "component_id")


def with_hex(found: DataFrame) -> DataFrame:
    return found.withColumn("fingerprint", hex16(F.col("fingerprint")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     max_bits: int = 3) -> DataFrame:
    """``docs`` with the row of the smallest id of each component only; columns
    and values unchanged. Rows that repeat the smallest id all stay, as do rows
    of a component without any id. A row goes by its id and its fingerprint: one
    id on texts of several components is decided in each of them."""
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64))

    gone = near_duplicates(docs, id_col, text_col, shingle, max_bits).filter(
        ~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("gone_id"), F.col("fingerprint").alias("gone_print")).distinct()
    rows = wrapped(docs).withColumn("print", hashed(F.col(f"row.`{text_col}`").cast("string")))
    return unwrapped(rows.join(gone, F.col(f"row.`{id_col}`").eqNullSafe(F.col("gone_id"))
                               & (F.col("print") == F.col("gone_print")), "left_anti"))
