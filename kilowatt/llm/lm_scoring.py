"""Cross-entropy difference: a target and a background n-gram model over one
vocabulary score each document by the mean difference of its token losses."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowatt.llm.shared import crc_fold, stored

#: Smoothing of single words: as if 2^18 words had been met 0.01 times each.
WORD_BITS = 18
_PRIOR, _PRIOR_ALL = 0.01, 0.01 * (1 << WORD_BITS)
_WORD = re.compile(r"\w+|[^\w\s]")
_SPACE = re.compile(r"\s")
_START = 0
_SLICE = 1 << 20


class _Slots(dict):
    """Numbers of the words met, in their order, from 1 on (0: the start mark);
    they hold within one vocabulary only."""

    def __missing__(self, word: str) -> int:
        self[word] = slot = len(self) + 1
        return slot


_SLOTS = _Slots()


def tokens(text: str, slots: _Slots | None = None) -> Iterator[np.ndarray]:
    """Word numbers of a whole lower-cased text, in slices; each slice begins with
    the last word before it (or the start mark)."""
    number = (_SLOTS if slots is None else slots).__getitem__
    last, at = _START, 0
    while at < len(text):
        gap = _SPACE.search(text, at + _SLICE)  # a word is never cut, however long
        end = gap.start() if gap else len(text)
        words = _WORD.findall(text[at:end].lower())
        at = end
        if words:
            found = np.fromiter(map(number, words), np.int64, len(words))
            yield np.concatenate([[last], found])
            last = int(found[-1])


def whole(text: str, slots: _Slots | None = None) -> np.ndarray:
    """Word numbers of a whole text after the start mark; no word: empty."""
    parts = [*tokens(text, slots)]
    return np.concatenate([parts[0], *(s[1:] for s in parts[1:])]) if parts else np.zeros(0, np.int64)


def pairs(slots: np.ndarray) -> np.ndarray:
    """The word pairs of a slice, both numbers in one."""
    return (slots[:-1] << 32) | slots[1:]


@dataclass
class DifferenceModel:
    """Counts of target (0) and background (1) per word number and per pair (the
    pairs of ``pair_key``, ascending), the background's scaled to the target's
    total. A word after another has the probability
    (pair count + mass × word share) / (count of the first + mass)."""
    word_n: np.ndarray
    pair_key: np.ndarray
    pair_n: np.ndarray
    totals: np.ndarray
    scale: float
    mass: float

    def score(self, text: str | None, in_target: bool = False) -> tuple[float, int]:
        """The score of a text in the numbers of this process, see ``judge``."""
        return self.judge(whole(text or ""), in_target)

    def judge(self, s: np.ndarray, in_target: bool) -> tuple[float, int]:
        """Mean of (background loss − target loss) per token of a whole text, and
        the number of tokens; positive: likelier in the target. No token: 0. A
        text is judged by the counts of the others: its own are taken off the
        models that hold it."""
        n = max(len(s) - 1, 0)
        if not n:
            return 0.0, 0
        share = np.array([[float(in_target)], [self.scale]])
        pair_n = self._others(pairs(s), self.pair_key, self.pair_n, share)
        word_n = self._others(s, None, self.word_n, share)
        word_p = (word_n[:, 1:] + _PRIOR) / (np.maximum(self.totals - share * n, 0) + _PRIOR_ALL)
        p = (pair_n + self.mass * word_p) / (word_n[:, :-1] + self.mass)
        return float(np.log(p[0] / p[1]).sum()) / n, n

    @staticmethod
    def _others(grams: np.ndarray, keys: np.ndarray | None, counts: np.ndarray, share: np.ndarray) -> np.ndarray:
        found, at, own = np.unique(grams, return_inverse=True, return_counts=True)
        slot = found if keys is None else np.searchsorted(keys, found)
        inside = np.minimum(slot, max(counts.shape[1] - 1, 0))
        met = (slot < counts.shape[1]) if keys is None else (slot < len(keys)) & (keys[inside] == found if len(keys) else False)
        return np.maximum(np.where(met, counts[:, inside] if counts.shape[1] else 0.0, 0.0) - share * own, 0)[:, at]


def _chunks(rows: DataFrame, chars: int) -> DataFrame:
    """``rows(id, text, target)`` → one row per chunk of neighbouring texts, of
    about ``chars`` characters together (a longer text is a chunk of its own):
    ids, targets and sizes of its texts, its words, and all texts one after the
    other as numbers of these words (int32)."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, made = TaskContext.get().partitionId() << 32, 0, 0
        ids, targets, parts, slots = [], [], [], _Slots()

        def flush() -> pa.RecordBatch:
            one = [pa.array([first + made], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (
                pa.concat_arrays(ids), pa.array(targets, pa.bool_()), pa.array([len(p) for p in parts], pa.int32()), pa.array([*slots], pa.string()))),
                pa.array([pa.compress(np.concatenate(parts).tobytes(), "zstd", asbytes=True) if any(map(len, parts)) else b""], pa.binary())]
            return pa.RecordBatch.from_arrays(one, names=["chunk", "ids", "targets", "sizes", "words", "tokens"])

        for b in batches:
            for k, target in enumerate(b.column(2).to_pylist()):
                text = b.column(1)[k].as_py() or ""
                if ids and held + len(text) > chars:
                    yield flush()
                    made, held = made + 1, 0
                    ids, targets, parts, slots = [], [], [], _Slots()
                ids.append(b.column(0).slice(k, 1))
                targets.append(target)
                parts.append(whole(text, slots).astype(np.int32))
                held += len(text)
        if ids:
            yield flush()

    return rows.select("id", "text", "target").mapInArrow(
        run, f"chunk bigint, ids array<{kind}>, targets array<boolean>, sizes array<int>, words array<string>, tokens binary")


@dataclass
class _Chunk:
    """A chunk's own counts (target, all) by place: its words by number (0: the
    start mark), then its distinct pairs ``key``."""
    sizes: np.ndarray
    targets: np.ndarray
    numbers: np.ndarray
    words: pa.Array
    key: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, targets: pa.Scalar, sizes: pa.Scalar, words: pa.Scalar, packed: pa.Scalar) -> _Chunk:
        sizes, targets = np.asarray(sizes.values, np.int64), np.asarray(targets.values, bool)
        numbers = np.frombuffer(_unpacked(packed.as_py(), 4 * int(sizes.sum())), np.int32).astype(np.int64)
        spelt = pa.concat_arrays([pa.array([""], pa.string()), words.values.cast(pa.string())])
        start = np.zeros(len(numbers), bool)
        start[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        key, at = np.unique(pairs(numbers)[~start[1:]], return_inverse=True)
        mark = np.repeat(targets, sizes)
        inside = mark[1:][~start[1:]]
        counts = np.concatenate([np.stack([np.bincount(x[m], minlength=n), np.bincount(x, minlength=n)]) for x, m, n in (
            (numbers, mark, len(spelt)), (at, inside, len(key)))], 1)
        return cls(sizes, targets, numbers, spelt, key, counts)

    def dealt(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """All places, ordered by the bucket of their n-gram, and where each bucket begins."""
        h = np.fromiter((zlib.crc32(w.encode()) for w in self.words.to_pylist()), np.uint64, len(self.words)) * np.uint64(0x9E3779B97F4A7C15)
        h = np.concatenate([h, h[self.key >> 32] ^ (h[self.key & 0xFFFFFFFF] * np.uint64(0xC2B2AE3D27D4EB4F))])
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
        bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(buckets + 1))

    def spelt(self, places: np.ndarray) -> pa.Array:
        """The n-grams at ``places`` (words first): a word, or two with a blank between."""
        n = len(self.words)
        single = places < n
        of = self.key[places[~single] - n]
        both = pc.binary_join_element_wise(self.words.take(pa.array(of >> 32)), self.words.take(pa.array(of & 0xFFFFFFFF)), " ")
        return pa.concat_arrays([self.words.take(pa.array(places[single])), both])


def _unpacked(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, size, "zstd", asbytes=True) if size else b""


def _packed(counts: np.ndarray, kind: type) -> bytes:
    return pa.compress(counts.astype(kind).tobytes(), "zstd", asbytes=True)


def _counts(packed: pa.Scalar, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(_unpacked(packed.as_py(), 2 * n * np.dtype(kind).itemsize), kind).reshape(2, -1)


def _grams(chunks: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, chunk, size, grams, counts)``: each chunk's distinct n-grams with
    its counts, dealt by hash. The grams are spelt out, one a line and packed
    (words have no white space, the start mark is the empty word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                c = _Chunk.of(*(b.column(i)[k] for i in range(1, 5)))
                order, begin = c.dealt(buckets)
                for i in range(buckets):
                    places = order[begin[i]:begin[i + 1]]
                    if not len(places):
                        continue
                    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(places)], pa.int32()), c.spelt(places)), "\n")[0].as_buffer()
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), b.column(0).slice(k, 1), pa.array([text.size], pa.int64()),
                                                      pa.array([pa.compress(text, "zstd", asbytes=True) if text.size else b""], pa.binary()),
                                                      pa.array([_packed(c.counts[:, places], np.int32)], pa.binary())], names=["bucket", "chunk", "size", "grams", "counts"])

    return chunks.select("chunk", "targets", "sizes", "words", "tokens").mapInArrow(
        run, "bucket bigint, chunk bigint, size bigint, grams binary, counts binary")


def _met(table: pa.Table) -> tuple[pa.DictionaryArray, np.ndarray, list[int]]:
    """A bucket's n-grams of all chunks with their sums, and how many each chunk has."""
    lines = [pc.split_pattern(pa.array([_unpacked(g.as_py(), n.as_py()).decode()], pa.large_string()), "\n").values for g, n in zip(table["grams"], table["size"])]
    grams = pa.concat_arrays(lines).dictionary_encode()
    counts = np.concatenate([_counts(c, np.int32, len(x)) for c, x in zip(table["counts"], lines)], 1)
    at = grams.indices.to_numpy()
    return grams, np.stack([np.bincount(at, c, len(grams.dictionary)) for c in counts]).astype(np.int64), [len(x) for x in lines]


def _buckets(chunks: DataFrame, tokens: float, most: int) -> int:
    """As many as hold about ``most`` n-grams each, and enough to deal evenly."""
    return max(int(np.ceil(tokens / most)), 4 * int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _totals(chunks: DataFrame) -> tuple[float, float]:
    """Words of the target's texts and of all."""
    sizes = chunks.select(F.explode(F.arrays_zip("targets", "sizes")).alias("d")).select("d.*").withColumn("n", F.greatest(F.col("sizes") - 1, F.lit(0)).cast("long"))
    r = sizes.agg(F.sum(F.when(F.col("targets"), F.col("n"))).alias("t"), F.sum("n").alias("n")).first()
    return float(r["t"] or 0), float(r["n"] or 0)


def _model(key: np.ndarray, pair_n: np.ndarray, word_n: np.ndarray, totals: tuple[float, float], mass: float) -> DifferenceModel:
    """The model of counts (target, all) over some n-grams. Both models have the
    order (pairs of words, interpolated with single words by a Dirichlet mass)
    and the total mass: the background's counts are scaled to the target's
    total, so that smoothing weighs as much in either. Without target texts the
    two hold the same counts."""
    if not totals[0]:
        pair_n, word_n, totals = pair_n[[1, 1]], word_n[[1, 1]], (totals[1], totals[1])
    scale = totals[0] / max(totals[1], 1.0)
    by = np.array([[1.0], [scale]])
    return DifferenceModel(word_n * by, key, pair_n * by, np.array(totals)[:, None] * by, scale, mass)


def train(rows: DataFrame, mass: float = 2.0, chunk_chars: int = 20_000_000) -> DifferenceModel:
    """The model of all of ``rows(id, text, target)`` in this process, in its own
    word numbers: the background from every text, the target from those of the
    target. For a table whose n-grams fit here; ``cross_entropy_difference``
    never gathers them."""
    chunks = stored(_chunks(rows, chunk_chars), "chunks")

    def add(table: pa.Table) -> pa.Table:
        grams, n, _ = _met(table)
        return pa.Table.from_arrays([grams.dictionary.cast(pa.string()), pa.array(n[0]), pa.array(n[1])], names=["gram", "target", "n"])

    counts = _grams(chunks, 8).groupBy("bucket").applyInArrow(add, "gram string, target bigint, n bigint").collect()
    word = [(_SLOTS[r["gram"]] if r["gram"] else _START, r["target"], r["n"]) for r in counts if " " not in r["gram"]]
    pair = sorted(((_SLOTS[a] if a else _START) << 32 | _SLOTS[b], r["target"], r["n"]) for r in counts if " " in r["gram"] for a, b in [r["gram"].split(" ")])
    word_n = np.zeros((2, len(_SLOTS) + 1))
    for slot, *n in word:
        word_n[:, slot] = n
    return _model(np.array([p[0] for p in pair], np.int64), np.array([p[1:] for p in pair], float).reshape(-1, 2).T, word_n, _totals(chunks), mass)


def marked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
           target_value: int = 1) -> DataFrame:
    """``(id, text, target)`` per row of ``docs``: the texts are shuffled once to
    meet the labels (which grow as they do, so they aren't broadcast)."""
    wanted = labels.filter(F.col(label_col) == target_value).select(F.col(id_col).alias("id")).distinct().withColumn("marked", F.lit(True))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(wanted.hint("merge"), "id", "left")
    return rows.select("id", "text", F.coalesce("marked", F.lit(False)).alias("target"))


def scored(rows: DataFrame, mass: float = 2.0, chunk_chars: int = 20_000_000, bucket_grams: int = 2_000_000) -> DataFrame:
    """``rows(id, text, target)`` → ``(id, score, n_tokens)`` per row.

    Counts are kept by the n-gram itself and grow with the corpus. Texts are
    worked on by chunks: a chunk sends each of its distinct n-grams once, dealt
    over buckets (more of them for more texts); a bucket adds up equal n-grams
    and answers each chunk with the sums, in the order of its n-grams. So a
    frequent n-gram has one entry per chunk, not per text.
    """
    chunks = stored(_chunks(rows, chunk_chars), "chunks")
    totals, kind = _totals(chunks), dict(rows.dtypes)["id"]
    buckets = _buckets(chunks, totals[1], bucket_grams)

    def add(table: pa.Table) -> pa.Table:
        grams, n, sizes = _met(table)
        ends = np.cumsum(sizes)
        sums = n[:, grams.indices.to_numpy()]
        return pa.Table.from_arrays([table["chunk"], table["bucket"], pa.array([_packed(sums[:, e - k:e], np.int64) for k, e in zip(sizes, ends)], pa.binary())],
                                    names=["chunk", "bucket", "sums"])

    sums = _grams(chunks, buckets).groupBy("bucket").applyInArrow(add, "chunk bigint, bucket bigint, sums binary")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "score", "n_tokens"]
        one = left.combine_chunks().to_batches()[0]
        c = _Chunk.of(*(one.column(i)[0] for i in range(2, 6)))
        order, begin = c.dealt(buckets)
        sizes = np.diff(begin)
        n = np.zeros(c.counts.shape)
        n[:, order] = np.concatenate([_counts(r, np.int64, k) for r, k in zip(right.sort_by("bucket")["sums"], sizes[sizes > 0])], 1)
        model = _model(c.key, n[:, len(c.words):], n[:, :len(c.words)], totals, mass)
        found = [model.judge(part, bool(t)) for part, t in zip(np.split(c.numbers, np.cumsum(c.sizes)[:-1]), c.targets)]
        return pa.Table.from_arrays([one.column(1)[0].values, pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())], names=names)

    return chunks.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(judge, f"id {kind}, score double, n_tokens bigint")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                             target_value: int = 1, folds: int = 5, held: int = 0, **options) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``held_out``, ``score`` (mean
    background loss minus target loss per token), ``n_tokens``. Labels of the
    held fold are never used. Null or empty text: score 0, no tokens. Repeated
    rows count and are scored each; other columns are ignored."""
    known = labels.filter(crc_fold(id_col, folds) != held)
    rows = scored(marked(docs, known, id_col, text_col, label_col, target_value), **options)
    return rows.select(F.col("id").alias(id_col), (crc_fold("id", folds) == held).alias("held_out"), "score", "n_tokens")
