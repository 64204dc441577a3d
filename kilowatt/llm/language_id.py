"""Language identification: averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilowatt.llm.shared import crc_fold, stored, unwrapped, wrapped

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_BITS = 17
_ORDERS = 4
#: Characters turned into subwords at a time: bounds the memory of a long text.
_SLICE = 1 << 20
#: Code points below this are looked up, those above count as letters.
_KNOWN = 0x3000
_IS_LETTER = np.array([chr(c).isalpha() for c in range(_KNOWN)] + [True])
_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def subwords(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all 1- to 4-character subwords of a text, in slices.
    Letters are lower-cased, everything between letters is one blank, as are
    both ends. A slice goes on from the last characters of the one before and
    gives the subwords that end in it, so the slices change nothing."""
    text = text.lower()
    tail, after_letter = np.zeros(0, np.uint64), False
    for at in range(0, len(text), _SLICE):
        part = text[at:at + _SLICE] + (" " if at + _SLICE >= len(text) else "")
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        letter = _IS_LETTER[np.minimum(codes, _KNOWN)]
        if not len(tail) and not letter.any():
            continue  # nothing but what the first blank stands for
        codes = np.where(letter, codes, 32)[letter | np.append(after_letter, letter[:-1])].astype(np.uint64)
        after_letter = bool(letter[-1])
        if not len(tail):
            codes = np.append(np.uint64(32), codes)
        known = len(tail)
        codes = np.concatenate([tail, codes])
        tail = codes[-(_ORDERS - 1):]
        state = codes * _MULTIPLY
        for order in range(_ORDERS):
            if order:
                if len(state) < 2:
                    break
                state = (state[:-1] ^ (state[:-1] >> np.uint64(29))) * _MIX + codes[order:] * _MULTIPLY
            new = state[max(0, known - order):]
            yield ((new ^ (new >> np.uint64(32))) * _MIX >> np.uint64(64 - _BITS)).astype(np.int32)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    parts = [*subwords(text)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    found, count = np.unique(np.concatenate(parts), return_counts=True)
    return found.astype(np.int32), (count / count.sum()).astype(np.float32)


@dataclass
class LanguageModel:
    """``table``: each bucket's embedding times the softmax matrix, already over
    the temperature, and a last column that is 1 where training has met the
    bucket. Rejected: scores below ``threshold``, and texts of whose subwords
    less than the share ``known`` is in buckets that training has met."""
    langs: list[str]
    table: np.ndarray
    threshold: float
    known: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, rejected."""
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(len(self.langs) + 1), 0
        for part in subwords(text):
            total += self.table.take(part, axis=0).sum(0, dtype=np.float64)
            n += len(part)
        total /= max(n, 1)
        p = _softmax(total[:-1])
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold or total[-1] < self.known)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _bags(rows: DataFrame, pieces: int) -> list:
    """The training examples of a bounded set of rows: each whole text and
    ``pieces`` short stretches of it, as (lang, fold, whole, buckets, shares)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, lang, text in zip(*(c.to_pylist() for c in b.columns)):
                rng = np.random.default_rng(key & 0xFFFFFFFF)
                cuts = [(0, len(text))]
                for _ in range(pieces if len(text) > 40 else 0):
                    n = int(rng.integers(12, 200))
                    start = int(rng.integers(0, max(1, len(text) - n)))
                    cuts.append((start, start + n))
                for k, (i, j) in enumerate(cuts):
                    found, share = bag(text[i:j])
                    if len(found):
                        out.append((key, lang, k == 0, found.tobytes(), share.tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("key", "lang", "whole", "found", "share"), r)) for r in out], schema=pa.schema(
                [("key", pa.int64()), ("lang", pa.string()), ("whole", pa.bool_()), ("found", pa.binary()), ("share", pa.binary())]))

    return rows.mapInArrow(run, "key bigint, lang string, whole boolean, found binary, share binary").collect()


def _sample(docs: DataFrame, text_col: str, lang_col: str, rows: int, chars: int, lang_rows: int, seed: int) -> DataFrame:
    """``(key, lang, text)``: of the distinct texts per language the ``rows`` with
    the smallest seeded hashes, and of each language its ``lang_rows`` with the
    smallest. Of a text, a stretch of at most ``chars / rows`` characters from a
    place that its hash tells; copies of a text are one row."""
    usable = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")).filter(
        "text is not null and lang is not null").select(F.xxhash64("text", F.lit(seed)).alias("key"), "lang", "text")
    keys = stored(usable.select("lang", "key").distinct(), "keys")
    # of each language first the smallest of 64 parts, so that one task never sees more than that of a language
    part = F.row_number().over(Window.partitionBy("lang", F.pmod("key", F.lit(64))).orderBy("key"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    # (stored in between: else both windows would share one shuffle by language)
    few = stored(keys.withColumn("place", part).filter(F.col("place") <= lang_rows).select("lang", "key"), "few_keys")
    few = few.withColumn("place", place).filter(F.col("place") <= lang_rows)
    drawn = keys.orderBy("key", "lang").limit(rows).unionByName(few.select("lang", "key")).distinct().collect()
    most = max(chars // rows, 1)
    start = F.pmod("key", F.greatest(F.length("text") - F.lit(most - 1), F.lit(1)).cast("long")).cast("int") + 1
    return usable.join(F.broadcast(docs.sparkSession.createDataFrame(drawn, keys.schema)), ["lang", "key"]).select(
        "key", "lang", F.substring("text", start, F.lit(most)).alias("text")).distinct()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = 2000, sample_chars: int = 20_000_000,
          dim: int = 16, epochs: int = 6, rate: float = 0.2, reject: float = 0.001, pieces: int = 2, seed: int = 11, lang_rows: int = 100) -> LanguageModel:
    """Fits the model on a bounded sample of ``docs`` with a text and a language.

    The sample: the distinct texts with the smallest seeded hashes, ``sample_rows``
    of all and ``lang_rows`` of each language, and of each text a stretch of at
    most ``sample_chars / sample_rows`` characters. Their bags of subwords (bounded by the buckets) come to the driver, which
    runs the gradient descent (AdaGrad steps, one example at a time) on four
    fifths of them. On the last fifth the temperature is fitted, and the
    rejection limits: the score and the share of known subwords that all but
    ``reject`` of the whole texts reach, never above 1/2 and 2/3. No usable row: a model without languages, which
    answers ``und``.
    """
    examples = _bags(_sample(docs, text_col, lang_col, sample_rows, sample_chars, lang_rows, seed), pieces)
    examples.sort(key=lambda r: (r["key"], r["lang"], r["whole"], r["found"]))
    langs = sorted({r["lang"] for r in examples})
    if not langs:
        return LanguageModel([], np.zeros((1 << _BITS, 1), np.float32), 0.5, 0.0)
    at = {lang: i for i, lang in enumerate(langs)}
    data = [(np.frombuffer(r["found"], np.int32), np.frombuffer(r["share"], np.float32), at[r["lang"]], r["whole"], r["key"] % 5 == 0) for r in examples]
    fit = [d for d in data if not d[4]] or data
    check = [d for d in data if d[4]] or data

    rng = np.random.default_rng(seed)
    table = np.zeros((1 << _BITS, dim), np.float32)
    softmax = rng.normal(0, 1, (dim, len(langs))).astype(np.float32)
    table_steps, softmax_steps = np.full(1 << _BITS, 1e-8, np.float32), np.float32(1e-8) + np.zeros_like(softmax)
    for epoch in range(epochs):
        now = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(fit)):
            found, share, y, _, _ = fit[k]
            rows = table[found]
            mean = share @ rows
            error = _softmax(mean @ softmax)
            error[y] -= 1
            down = softmax @ error
            step = np.outer(mean, error)
            softmax_steps += step * step
            softmax -= now * step / np.sqrt(softmax_steps)
            table_steps[found] += (share * share) * float(down @ down) / dim
            table[found] = rows - now * np.outer(share / np.sqrt(table_steps[found]), down)
    logits = np.array([d[1] @ (table[d[0]] @ softmax) for d in check])
    truth, whole = np.array([d[2] for d in check]), np.array([d[3] for d in check])
    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(_softmax(logits / h)[np.arange(len(truth)), truth], 1e-12)).mean() for h in heats]
    heat = heats[int(np.argmin(loss))]
    met = np.zeros((1 << _BITS, 1), np.float32)
    for found, *_ in fit:
        met[found] = 1
    limits = (0.5, 2 / 3)
    if whole.any():
        score = _softmax(logits / heat).max(1)[whole]
        share = [float(d[1] @ met[d[0], 0]) for d in check if d[3]]
        limits = tuple(min(most, float(np.quantile(x, reject))) for most, x in zip(limits, (score, share)))
    return LanguageModel(langs, np.hstack([table @ softmax / heat, met]).astype(np.float32), *limits)


def predicted(docs: DataFrame, model: LanguageModel, text: Column) -> Column:
    """Column ``struct<lang_pred string, score double, rejected boolean>`` of
    whole texts. Null, or no letter: ``und`` with score 0, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        found = [m.predict(t) for t in texts]
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                             "rejected": [f[2] for f in found]})

    return run(text.cast("string"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
             held: int = 1, **options) -> DataFrame:
    """One row per row: ``id_col``, ``held_out``, ``lang_pred``, ``score``,
    ``rejected``. Learns from the rows whose fold of the id is not ``held``.
    Repeated rows get the same answer; other columns are ignored."""
    fold = crc_fold(id_col, folds) == held
    model = train(docs.filter(~fold), text_col, lang_col, **options)
    rows = docs.select(F.col(id_col), fold.alias("held_out"), predicted(docs, model, F.col(text_col)).alias("found"))
    return rows.select(id_col, "held_out", "found.lang_pred", "found.score", "found.rejected")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3,
                    held: int = 1, **options) -> DataFrame:
    """The rows of ``docs`` whose language isn't rejected; columns unchanged."""
    model = train(docs.filter(crc_fold(id_col, folds) != held), text_col, lang_col, **options)
    rows = wrapped(docs)
    return unwrapped(rows.filter(~predicted(docs, model, F.col(f"row.`{text_col}`"))["rejected"]))
