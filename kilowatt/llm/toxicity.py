"""Toxicity: gradient-boosted trees over dense features of a text, calibrated
by isotonic regression. The lexicon is learned from the labelled rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatt.llm.shared import crc_fold, stored

_FOLDS = 4
_TOKEN = regex.compile(r"[^\s]+")
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "¡¿«»“”‘’…"
_MIXED = regex.compile(r"\p{L}[\d@$!*#+|]+\p{L}")
_REPEAT = regex.compile(r"(.)\1{2,}")
_SYMBOLS = regex.compile(r"[#$%&*@^~_|<>=+]")
_STRETCH = regex.compile(r"[!?]{2,}")
_WORD_END = regex.compile(r"(?<=\S)\s")
#: Characters that stand for letters in disguised words (fixed values).
_DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l",
                           "*": None, "-": None, "_": None, ".": None, "+": None, "#": None})
#: Words that address a reader, in the languages of the corpus (fixed values).
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner euch ihr tu te toi ton ta tes vous votre "
                          "vos usted ustedes ti tú tus vosotros os".split())
#: Bytes of text worked on together, and words remembered by a worker.
_SLICE = 1 << 20
_REMEMBERED = 200_000
FEATURES = ("words", "density", "hits", "share", "strongest", "distinct", "second_person", "near_second_person",
            "capitals", "shouted", "exclaimed", "symbols", "mixed", "repeated")


def bare(token: str) -> str:
    """A word without its edge punctuation, lower case; disguised letters undone
    where letters surround them."""
    word = token.strip(_EDGE).lower()
    if _MIXED.search(word):
        word = word.translate(_DISGUISE)
    return word


def terms(word: str) -> tuple[str, ...]:
    """What the lexicon may hold for a word: the word, and its first 4 and 5
    letters (as stems, marked by a hyphen)."""
    return (word, *(word[:n] + "-" for n in (4, 5) if len(word) >= n)) if word else ()


class Lexicon(dict):
    """Weight of each word met: the largest weight of its terms, 0 if none, and
    -1 for a word that addresses the reader."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
        word = bare(token)
        weight = -1.0 if word in SECOND_PERSON else max([self.weights.get(t, 0.0) for t in terms(word)], default=0.0)
        if len(token) <= 64:
            self[token] = weight
        return weight

    def term(self, token: str) -> str:
        """The term that gives a word its weight."""
        return max(terms(bare(token)), key=lambda t: self.weights.get(t, 0.0))


def features(text: str | None, lexicon: Lexicon, near: int = 3) -> np.ndarray:
    """The dense features of one whole text (see FEATURES), worked on in slices that
    change nothing: a slice ends between a word and a space, which no pattern
    spans, and the last words are carried on for the distance to the reader.
    ``distinct`` counts the lexicon's terms met, which the lexicon bounds."""
    text = text or ""
    n = hits = second = close = shouted = 0
    weight = strongest = 0.0
    distinct: set[str] = set()
    counts = np.zeros(6)
    at = 0
    # of the last words: addresses the reader, is a hit not yet known to be close to that
    open_you, open_hit = np.zeros(0, bool), np.zeros(0, bool)
    while at < len(text):
        gap = _WORD_END.search(text, at + _SLICE) if at + _SLICE < len(text) else None
        end = gap.start() if gap else len(text)
        part, at = text[at:end], end
        tokens = _TOKEN.findall(part)
        w = np.fromiter(map(lexicon.__getitem__, tokens), np.float64, len(tokens))
        you = w < 0
        w[you] = 0
        hit = np.flatnonzero(w)
        n, hits, weight, second = n + len(tokens), hits + len(hit), weight + float(w.sum()), second + int(you.sum())
        if len(hit):
            strongest = max(strongest, float(w.max()))
            distinct.update(map(lexicon.term, {tokens[i] for i in hit}))
        all_you, all_hit = np.append(open_you, you), np.append(open_hit, w > 0)
        if all_you.any() and all_hit.any():
            ones = np.append(0, np.cumsum(all_you))
            place = np.arange(len(all_you))
            around = ones[np.minimum(place + near + 1, len(all_you))] > ones[np.maximum(place - near, 0)]
            close += int((around & all_hit).sum())
            all_hit &= ~around
        open_you, open_hit = (x[max(0, len(x) - near):] for x in (all_you, all_hit))
        shouted += sum(map(str.isupper, tokens))
        counts += (sum(map(str.isupper, part)), len(part), len(_STRETCH.findall(part)) + part.count("!"), len(_SYMBOLS.findall(part)),
                   len(_MIXED.findall(part)), len(_REPEAT.findall(part)))
    words, chars = max(n, 1), max(counts[1], 1)
    return np.array([np.log1p(n), weight / words, np.log1p(hits), hits / words, strongest, np.log1p(len(distinct)), second / words,
                     close / max(hits, 1), counts[0] / chars, shouted / words, counts[2] / words, counts[3] / chars,
                     counts[4] / words, counts[5] / words], np.float32)


@dataclass
class Tree:
    """A tree of depth ``d`` as arrays: feature and limit of the inner nodes in
    level order, values of the leaves."""
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(int(np.log2(len(self.value)))):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.limit[node])
        return self.value[node - len(self.feature)]


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((t(x) for t in self.trees), np.zeros(len(x)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.15, depth: int = 3, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Newton-boosted trees for the logistic loss, on histograms of ``bins``
    quantiles per feature."""
    p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Boosted(float(np.log(p / (1 - p))), rate)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    raw = np.full(len(y), model.base)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-raw))
        g, h = q - y, np.maximum(q * (1 - q), 1e-6)
        inner, leaves = 2 ** depth - 1, 2 ** depth
        tree = Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves))
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            at = np.flatnonzero(node == k)
            best = (1e-6, 0, np.inf, bins)
            if len(at) > 1:
                total_g, total_h = g[at].sum(), h[at].sum()
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    lg = np.cumsum(np.bincount(binned[at, f], g[at], len(e) + 1))[:-1]
                    lh = np.cumsum(np.bincount(binned[at, f], h[at], len(e) + 1))[:-1]
                    gain = lg ** 2 / (lh + ridge) + (total_g - lg) ** 2 / (total_h - lh + ridge) - total_g ** 2 / (total_h + ridge)
                    b = int(gain.argmax())
                    if gain[b] > best[0]:
                        best = (gain[b], f, e[b], b)
            tree.feature[k], tree.limit[k] = best[1], best[2]
            node[at] = 2 * k + 1 + (binned[at, best[1]] > best[3])
        leaf = node - inner
        tree.value = -np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        raw += rate * tree.value[leaf]
        model.trees.append(tree)
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots (score, probability), both ascending."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        blocks.append([float(v), 1.0, float(s)])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            v2, n2, s2 = blocks.pop()
            blocks[-1][0] += v2
            blocks[-1][2] = (blocks[-1][2] * blocks[-1][1] + s2 * n2) / (blocks[-1][1] + n2)
            blocks[-1][1] += n2
    return np.array([b[2] for b in blocks]), np.array([(b[0] + 0.5 * y.mean()) / (b[1] + 0.5) for b in blocks])


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Boosted | None
    knots: tuple[np.ndarray, np.ndarray]
    constant: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.trees.raw(x), *self.knots), 0.0, 1.0)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` labelled texts: ``(id, y, fold, text)``, stored. First the
    ``rows`` ids of the smallest seeded hashes, a bounded table that the texts
    meet without a shuffle; then, as an id may have any number of texts, of the
    distinct (label, text) pairs the ``rows`` with the smallest hashes."""
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(label_col).cast("int")).alias("y"))
    drawn = marked.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(rows)
    drawn = drawn.sparkSession.createDataFrame(drawn.collect(), drawn.schema)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(drawn), "id").withColumn("key", F.xxhash64("text", F.lit(seed + 2))).groupBy("y", "key").agg(
        F.min("id").alias("id"), F.first("text").alias("text"))
    found = stored(found.withColumn("fold", F.pmod(F.xxhash64("text", F.lit(seed + 1)), F.lit(_FOLDS)).cast("int")), "found")
    keys = found.select("y", "key").orderBy("key", "y").limit(rows)
    keys = keys.sparkSession.createDataFrame(keys.collect(), keys.schema)
    return stored(found.join(F.broadcast(keys), ["y", "key"]).select("id", "y", "fold", "text"), "labelled")


def _counts(sample: DataFrame) -> DataFrame:
    """Documents per term, fold and class, combined per batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for y, fold, text in zip(*(c.to_pylist() for c in b.columns)):
                found.update((t, 2 * fold + y) for t in {t for w in set(map(bare, _TOKEN.findall(text or ""))) for t in terms(w)})
            keys = [*found]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                              pa.array([found[k] for k in keys], pa.int64())], names=["term", "cell", "n"])

    cells = sample.select(F.col("y").cast("int"), "fold", "text").mapInArrow(run, "term string, cell int, n bigint")
    return cells.groupBy("term").agg(*[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(2 * _FOLDS)])


def _weights(counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Log odds of toxic against clean documents that hold a term; 0 unless at
    least two toxic ones do and it is far likelier there."""
    toxic, clean = counts[:, 1], counts[:, 0]
    odds = np.log((toxic + 0.5) / (docs[1] + 1)) - np.log((clean + 0.5) / (docs[0] + 1))
    return np.where((toxic >= 2) & (odds > 2.0) & (toxic > clean), odds, 0.0)


def _matrix(sample: DataFrame, lexicons: list[dict[str, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the sampled rows, each under the lexicon of its fold."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicons)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [Lexicon(w) for w in shared.value]
        for b in batches:
            ids, y, fold, text = (c.to_pylist() for c in b.columns)
            x = [features(t, mine[f]).tobytes() for f, t in zip(fold, text)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(y, pa.int32()), pa.array(fold, pa.int32()), pa.array(x, pa.binary())],
                                             names=["id", "y", "fold", "x"])

    rows = sample.select(F.xxhash64("id").alias("id"), F.col("y").cast("int"), "fold", "text").mapInArrow(
        run, "id bigint, y int, fold int, x binary").collect()
    rows.sort(key=lambda r: (r["id"], r["x"]))
    return (np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(len(rows), len(FEATURES)),
            np.array([r["y"] for r in rows], float), np.array([r["fold"] for r in rows]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = 8000, lexicon_size: int = 4096, seed: int = 13) -> ToxicityModel:
    """Fits the model on at most ``sample_rows`` labelled rows of ``labels``.

    The lexicon holds the ``lexicon_size`` words and stems with the highest log
    odds among those whose likelihood ratio is beyond what the number of terms
    explains by chance; for training, a row's features come from a lexicon counted without
    the row's fold. Trees fitted without a fold score that fold, and these
    scores give the isotonic calibration; the final trees see all folds. No
    labelled text: the score is 0; one class only: its label.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, sample_rows, seed)
    sizes = {(r["fold"], r["y"]): r["count"] for r in sample.groupBy("fold", "y").count().collect()}
    total = [sum(n for (_, y), n in sizes.items() if y == c) for c in (0, 1)]
    if not total[0] or not total[1]:
        return ToxicityModel({}, None, (np.zeros(1), np.zeros(1)), 1.0 if total[1] else 0.0)
    toxic = sum(F.col(f"c{2 * f + 1}") for f in range(_FOLDS))
    clean = sum(F.col(f"c{2 * f}") for f in range(_FOLDS))
    odds = F.log((toxic + 0.5) / (total[1] + 1)) - F.log((clean + 0.5) / (total[0] + 1))
    both, rate = toxic + clean, total[1] / (total[0] + total[1])
    evidence = 2 * (toxic * F.log(toxic / (both * rate)) + F.when(clean > 0, clean * F.log(clean / (both * (1 - rate)))).otherwise(0.0))
    counts = stored(_counts(sample), "terms")
    chance = 2 * float(np.log(max(counts.count(), 2)))
    top = counts.filter((toxic >= 2) & (odds > 2.0)).filter(evidence > chance).orderBy((odds * F.sqrt(toxic)).desc(), "term").limit(lexicon_size).collect()
    words = [r["term"] for r in top]
    cells = np.array([[r[f"c{c}"] for c in range(2 * _FOLDS)] for r in top], float).reshape(len(top), _FOLDS, 2)

    def lexicon(without: int | None) -> dict[str, float]:
        seen = [f for f in range(_FOLDS) if f != without]
        n = np.array([sum(sizes.get((f, c), 0) for f in seen) for c in (0, 1)])
        return {w: float(v) for w, v in zip(words, _weights(cells[:, seen].sum(1), n)) if v > 0}

    x, y, fold = _matrix(sample, [lexicon(f) for f in range(_FOLDS)])
    raw = np.zeros(len(y))
    for f in range(_FOLDS):
        if (fold == f).any():
            rest = fold != f if len(set(y[fold != f])) == 2 else np.ones(len(y), bool)
            raw[fold == f] = boost(x[rest], y[rest]).raw(x[fold == f])
    return ToxicityModel(lexicon(None), boost(x, y), isotonic(raw, y))


def scored(docs: DataFrame, model: ToxicityModel, text: Column) -> Column:
    """Column ``double``: the calibrated score of whole texts; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        lexicon = Lexicon(m.lexicon)
        for texts in batches:
            x = np.array([features(t, lexicon) for t in texts]).reshape(len(texts), len(FEATURES))
            yield pd.Series(m.scores(x), dtype="float64")

    return run(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             folds: int = 5, held: int = 0, **options) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``held_out``, ``score``,
    ``predicted``. Learns from labels whose fold of the id is not ``held``; only
    the text enters a score. Null and empty texts are scored as texts without
    words. Repeated rows get the same score; of several labels of an id, the
    highest counts; labels that are null, or of ids without a row, are ignored."""
    model = train(docs, labels.filter(crc_fold(id_col, folds) != held), id_col, text_col, label_col, **options)
    rows = docs.select(F.col(id_col), (crc_fold(id_col, folds) == held).alias("held_out"), scored(docs, model, F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
