"""Phrase collocations by prefix-free parsing.

Texts are cut into overlapping chunks where the content says so, equal chunks
become one entry of a dictionary with its frequency, and n-grams are counted
inside distinct chunks, weighted by that frequency. Neighbouring chunks share
``words - 1`` tokens, and an n-gram counts in the chunk whose own part it
starts in, so each occurrence counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilowatt.llm.shared import stored

#: Bytes that end a piece, and the byte that stands for them all: no word can hold it.
_ENDS, _END = b".,;:!?\n\x0b\x0c\r", b"."
_FOLD = bytes(46 if i in _ENDS else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))
#: Bytes of text, and tokens of the dictionary, that a task looks at together.
_BYTES, _TOKENS = 4 << 20, 1 << 20
_SEED = 42


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xBF58476D1CE4E5B9)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w or "", _SEED) for w in words.to_pylist()), np.uint64, len(words))


def _normal(text: bytes) -> bytes:
    """A-Z lower-cased, every end of a piece as a token of its own."""
    return text.translate(_FOLD).replace(_END, b" . ")


def _slices(text: bytes, size: int) -> Iterator[tuple[bytes, bool]]:
    """Parts of a normalised text, cut at spaces, and whether a part is the last."""
    at = 0
    while len(text) - at > size and (cut := text.find(b" ", at + size)) >= 0:
        yield text[at:cut], False
        at = cut
    yield text[at:], True


def _starts(hashes: np.ndarray, ends: np.ndarray, overlap: int, modulus: int, longest: int) -> np.ndarray:
    """Where chunks start, for tokens of several texts that end at ``ends``: at
    each text's first token, at each window of ``overlap`` tokens whose hash is
    divisible by ``modulus``, and ``longest`` tokens after a start without one.
    Only a text's first start may have fewer than ``overlap`` tokens left."""
    n = len(hashes)
    window = np.zeros(max(0, n - overlap + 1), np.uint64)
    for k in range(overlap):
        window = _mix(window + hashes[k:k + len(window)])
    trigger = np.zeros(n, bool)
    trigger[:len(window)] = window % np.uint64(modulus) == 0
    for k in range(1, overlap):  # windows that reach into the next text
        trigger[np.maximum(ends - k, 0)] = False
    trigger[np.append(0, ends[:-1])[np.append(0, ends[:-1]) < n]] = True
    starts = np.flatnonzero(trigger)
    gaps = np.diff(np.append(starts, n))
    if (gaps > longest).any():
        more = (gaps - 1) // longest
        again = np.repeat(starts, more) + longest * (np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1)
        again = again[again + overlap <= ends[np.searchsorted(ends, again, side="right")]]
        starts = np.sort(np.append(starts, again))
    return starts


def _chunks(texts: list[tuple[str, bytes, bool]], overlap: int, modulus: int, longest: int) -> tuple[pa.RecordBatch, bytes]:
    """Chunks of normalised texts ``(lang, text, complete)``; only the last text
    may be incomplete, and what it leaves open comes back as text."""
    words = pc.ascii_split_whitespace(pa.array([t.strip(b" ") for _, t, _ in texts], pa.large_binary()).cast(pa.large_string()))
    keep = [i for i, (_, t, _) in enumerate(texts) if t.strip(b" ")]
    words = words.take(pa.array(keep, pa.int64()))
    sizes = np.diff(words.offsets.to_numpy()) if keep else np.zeros(0, np.int64)
    flat = words.flatten().dictionary_encode()
    ends = np.cumsum(sizes)
    hashes = _hashes(flat.dictionary)[flat.indices.to_numpy()] if keep else np.zeros(0, np.uint64)
    starts = _starts(hashes, ends, overlap, modulus, longest) if keep else np.zeros(0, np.int64)
    goes_on = bool(keep) and not texts[-1][2] and keep[-1] == len(texts) - 1
    if goes_on:  # a start whose overlap isn't there yet is found again in the next slice
        starts = starts[(starts + overlap <= len(hashes)) | (starts <= len(hashes) - sizes[-1])]
    text_of = np.searchsorted(ends, starts, side="right")
    following = np.append(starts[1:], len(hashes))
    last = following == ends[text_of]
    stops = np.where(last, following, np.minimum(following + overlap, ends[text_of]))
    rest = b""
    if goes_on:
        rest = b" ".join(w.encode() for w in flat.take(pa.array(np.arange(starts[-1], stops[-1]))).to_pylist())
        starts, stops, last, text_of = starts[:-1], stops[:-1], last[:-1], text_of[:-1]
    size = stops - starts
    offsets = np.append(0, np.cumsum(size))
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, size)
    tokens = flat.dictionary.take(flat.indices.take(pa.array(at))).cast(pa.large_string())
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), tokens), pa.scalar(" ", pa.large_string()))
    langs = pa.array([texts[keep[i]][0] for i in text_of], pa.string())
    return pa.RecordBatch.from_arrays([langs, joined.cast(pa.string()), pa.array(last)], names=["lang", "chunk", "last"]), rest


def _parsed(batches: Iterator[pa.RecordBatch], overlap: int, modulus: int, longest: int, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[str, bytes, bool]] = []
    total = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            rest = b""
            for part, done in _slices(_normal(text.as_buffer().to_pybytes()), size):
                part = rest + b" " + part if rest else part
                held.append((lang, part, done))
                total += len(part)
                if total >= size or not done:
                    out, rest = _chunks(held, overlap, modulus, longest)
                    yield out
                    held, total = [], 0
    if held:
        yield _chunks(held, overlap, modulus, longest)[0]


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = 5, modulus: int = 32,
               longest: int = 1024, slice_bytes: int = _BYTES) -> DataFrame:
    """The dictionary of the parse: ``lang``, ``chunk`` (tokens joined by spaces,
    ``.`` for the end of a piece), ``last`` (nothing follows in its text),
    ``count`` (how often it occurs).

    A chunk ends ``words - 1`` tokens after the next one's start, and starts
    depend on nearby content only, so passages that texts share give the same
    chunks wherever they stand. A chunk holds at most ``longest + words`` tokens.
    Long texts pass in slices; what is open at the end of one is carried into
    the next, so the chunks do not depend on the slices. Null text: empty, no
    chunk. Null language: ``und``. Copies are combined before the shuffle.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    parsed = rows.mapInArrow(lambda b: _parsed(b, words - 1, modulus, longest, slice_bytes), "lang string, chunk string, last boolean")
    return parsed.groupBy("lang", "chunk", "last").agg(F.count("*").alias("count"))


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Place of each hash in a filter of ``2 ** bits`` bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


class _Block:
    """Tokens of several dictionary entries, as numbers."""

    def __init__(self, b: pa.RecordBatch, overlap: int):
        lists = pc.split_pattern(b.column(1).cast(pa.large_string()), " ")
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().dictionary_encode()
        self.names, self.ids = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
        langs = b.column(0).dictionary_encode()
        self.langs, lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
        n = len(self.ids)
        ends = np.cumsum(size)
        last = b.column(2).to_numpy(zero_copy_only=False)
        self.lang = np.repeat(lang, size)
        self.weight = np.repeat(b.column(3).to_numpy(), size)
        self.end = np.repeat(ends, size)
        self.word = ~pc.equal(self.names, ".").to_numpy(zero_copy_only=False)[self.ids] if n else np.zeros(0, bool)
        self.own = np.arange(n) < np.repeat(np.where(last, ends, ends - overlap), size)
        self.word_hash = _hashes(self.names)
        self.lang_hash = _hashes(self.langs)
        #: hash of (language, word) at each position
        self.first_hash = _mix(self.lang_hash[self.lang] ^ _mix(self.word_hash[self.ids]))

    def pair_hash(self, at: np.ndarray) -> np.ndarray:
        return _pair(self.first_hash[at], self.word_hash[self.ids[at + 1]])

    def rows(self, n: int, first: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        """The n-grams that begin at ``first``, each a key of its phrase, a tab
        (which no phrase holds) and its language, with their counts."""
        at = (first[:, None] + np.arange(n)).ravel()
        tokens = self.names.take(pa.array(self.ids[at]))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.arange(len(first) + 1) * n, pa.int64()), tokens), pa.scalar(" ", pa.large_string()))
        langs = self.langs.take(pa.array(self.lang[first])).cast(pa.large_string())
        keys = pc.binary_join_element_wise(joined, langs, pa.scalar("\t", pa.large_string()))
        return pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(count, pa.int64())], names=["key", "f"])


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * np.uint64(3) + second)


def _summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys: first position of each, its number at each position, sum of weights."""
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, number, weight)
    return first, number, total


def _blocks(batches: Iterator[pa.RecordBatch], overlap: int, tokens: int) -> Iterator[_Block]:
    """Entries gathered until their text is about ``tokens`` tokens long."""
    held, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            held.append(part)
            size += part.column(1).nbytes // 5
            if size >= tokens:
                yield _Block(pa.Table.from_batches(held).combine_chunks().to_batches()[0], overlap)
                held, size = [], 0
    if size:
        yield _Block(pa.Table.from_batches(held).combine_chunks().to_batches()[0], overlap)


def _count(batches: Iterator[pa.RecordBatch], lengths: tuple[int, ...], words_seen: np.ndarray | None, pairs_seen: np.ndarray | None,
           bits: int, overlap: int, tokens: int) -> Iterator[pa.RecordBatch]:
    """Weighted counts of the n-grams of ``lengths`` in each block of entries; an
    n-gram whose words or word pairs are surely too rare is left out. Numbers of
    n-grams are made from those one word shorter, so equal numbers are equal n-grams."""
    for b in _blocks(batches, overlap, tokens):
        n_ids = len(b.names)
        fine = b.word.copy()
        if words_seen is not None:
            fine &= words_seen[_bits(b.first_hash, bits)]
        at = np.flatnonzero(fine & b.own)
        number = b.lang[at] * n_ids + b.ids[at]
        first, number, total = _summed(number, b.weight[at])
        if 1 in lengths:
            yield b.rows(1, at[first], total)
        if pairs_seen is not None:
            fine[:-1] &= fine[1:] & pairs_seen[_bits(b.pair_hash(np.arange(len(fine) - 1)), bits)]
        for n in range(2, max(lengths) + 1):
            # the n-gram at i goes on from the one at i that is a word shorter, and its last pair is fine as well
            reach = at + n - 1 < b.end[at]
            at, number = at[reach], number[reach]
            go = fine[at + n - 2] if pairs_seen is not None else fine[at + n - 1]
            at, number = at[go], number[go]
            first, number, total = _summed(number * n_ids + b.ids[at + n - 1], b.weight[at])
            if n in lengths and len(at):
                yield b.rows(n, at[first], total)


def _filter(frequent: DataFrame, bits: int) -> np.ndarray:
    """A filter of ``2 ** bits`` bits that knows all given phrases of one or two
    words. Its size is fixed; where it fills up it lets more through."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = _mix(_hashes(b.column(0)) ^ _mix(_hashes(b.column(1))))
            two = pc.is_valid(b.column(2)).to_numpy(zero_copy_only=False)
            h = np.where(two, _pair(h, _hashes(b.column(2))), h)
            yield pa.RecordBatch.from_arrays([pa.array(_bits(h, bits) + 1)], names=["place"])

    words = F.split("phrase", " ")
    rows = frequent.select("lang", words[0].alias("a"), F.when(F.col("n") == 2, F.get(words, F.lit(1))).alias("b"))
    maps = rows.mapInArrow(places, "place long").groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    out = np.zeros(max(1 << bits, 1 << 15), bool)
    for r in maps.collect():
        at = (r["bucket"] - 1) << 15
        out[at:at + (1 << 15)] |= np.unpackbits(np.frombuffer(bytes(r["bitmap"]), np.uint8), bitorder="little").view(bool)
    return np.packbits(out)


def counted(entries: DataFrame, lengths: tuple[int, ...], words_seen: np.ndarray | None = None, pairs_seen: np.ndarray | None = None,
            bits: int = 25, words: int = 5, tokens: int = _TOKENS) -> DataFrame:
    """``entries`` of the dictionary → ``lang``, ``phrase``, ``n``, ``f``: frequency of
    every n-gram of ``lengths`` (1 to ``words``) that the filters let through."""
    sc = entries.sparkSession.sparkContext
    shared = [None if s is None else sc.broadcast(s.tobytes()) for s in (words_seen, pairs_seen)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [None if s is None else np.unpackbits(np.frombuffer(s.value, np.uint8)).view(bool) for s in shared]
        yield from _count(batches, lengths, *seen, bits, words - 1, tokens)

    out = entries.select("lang", "chunk", "last", "count").mapInArrow(run, "key string, f long").groupBy("key").agg(F.sum("f").alias("f"))
    phrase = F.substring_index("key", "\t", 1)
    return out.select(F.expr("substring(key, locate('\t', key) + 1)").alias("lang"), phrase.alias("phrase"),
                      (F.regexp_count(phrase, F.lit(" ")) + 1).alias("n"), "f")


def phrase_counts(entries: DataFrame, words: int = 5, least: int = 100, bits: int = 25, tokens: int = _TOKENS) -> tuple[DataFrame, DataFrame]:
    """``(frequent, totals)``: all n-grams of 1 to ``words`` words that occur at
    least ``least`` times in their language, and the words of each language.

    Words are counted first, then pairs of frequent words, then longer n-grams
    of frequent pairs: an n-gram is no more frequent than its parts, so nothing
    is lost. What passes is known to the tasks by a filter of ``2 ** bits`` bits
    (4 MB); it may let too much through, which is counted and dropped later.
    """
    single = stored(counted(entries, (1,), words=words, tokens=tokens), "words")
    totals = single.groupBy("lang").agg(F.sum("f").alias("total"))
    often = single.filter(F.col("f") >= least)
    words_seen = _filter(often, bits)
    pairs = stored(counted(entries, (2,), words_seen, None, bits, words, tokens).filter(F.col("f") >= least), "pairs")
    more = counted(entries, tuple(range(3, words + 1)), words_seen, _filter(pairs, bits), bits, words, tokens).filter(F.col("f") >= least)
    return stored(often.unionByName(pairs).unionByName(more), "phrases"), totals


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _shortened(table: DataFrame) -> DataFrame:
    """The longest frequency of a candidate one word longer that holds the phrase:
    longer ones that hold it as often hold one of these in between."""
    words, n = F.split("phrase", " "), F.col("n")
    return table.filter("n > 2").select("lang", "f", F.explode(F.array(_part(words, F.lit(1), n - 1), _part(words, F.lit(2), n - 1))).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("longer"))


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates that no longer one absorbs, with their lowest-scoring cut:
    ``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and the exact ``score``."""
    table = frequent.withColumnRenamed("f", "a")
    kept = table.filter("n > 1").join(_shortened(frequent), ["lang", "phrase"], "left").filter("longer is null or longer < a")
    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "a", F.col("n").alias("size"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(words, F.lit(1), F.col("k")).alias("left"),
                       _part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    of = lambda side, name: table.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(
        totals.select("lang", F.col("total").alias("n")), "lang")
    big = "decimal(19,0)"
    score = F.expr(f"(cast(a * 1000 as {big}) * cast(n as {big})) div (cast(l as {big}) * cast(r as {big}))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    return best.select("lang", "phrase", *[F.col(f"cut.{c}").cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = 5, least: int = 100,
                 top: int = 2000, modulus: int = 32, bits: int = 25) -> DataFrame:
    """The first ``top`` phrases of 2 to ``words`` words of each language: ``lang``,
    ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A text (null: empty) is lower-cased (A-Z), cut into pieces at ``.,;:!?`` and
    line ends, and these into words at spaces and tabs. ``a`` counts all
    occurrences within pieces, overlapping ones and those of repeated rows
    included; ``n`` counts the language's words (null language: ``und``). Each cut
    of a phrase into two scores ``1000 a n / (l r)``, rounded down; the lowest
    counts, ties to the shorter first part. A phrase within a longer candidate
    that is as frequent is dropped. Ties in rank: larger ``a``, then the phrase
    by bytes. No rows, or nothing frequent enough: empty. Other columns are ignored.
    """
    entries = stored(dictionary(docs, text_col, lang_col, words, modulus), "chunks")
    found = stored(scored(*phrase_counts(entries, words, least, bits)), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first within parts of a language, so that a last task sees `top` rows of each part at most
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return last.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
