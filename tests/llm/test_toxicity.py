import zlib

import numpy as np
import pytest

from kilowatt.llm import toxicity

SF = "/root/testdata/sf0.1"


def auc(score, truth):
    order = np.argsort(np.argsort(score))
    n1 = truth.sum()
    return (order[truth == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(truth) - n1))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    score, y = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    assert auc(score, y) > 0.97
    assert ((score >= 0.5) == y).mean() > 0.97
    assert (score[y == 0] >= 0.5).mean() < 0.01


def test_boosting_and_isotonic_regression():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = toxicity.boost(x, y)
    assert ((model.raw(x) > 0) == y).mean() > 0.97
    at, p = toxicity.isotonic(rng.normal(size=500), rng.integers(0, 2, 500).astype(float))
    assert (np.diff(at) >= 0).all() and (np.diff(p) >= -1e-9).all() and 0 <= p.min() and p.max() <= 1


def test_disguised_words():
    assert toxicity.bare("iD1ot!!!") == "idiot" and toxicity.bare("cl*wn") == "clwn" and toxicity.bare("2024") == "2024"


@pytest.mark.parametrize("size", [1, 7, 50, 300])
def test_slices_do_not_matter(monkeypatch, size):
    lexicon = toxicity.Lexicon({"idiot": 3.0, "lowe-": 2.0, "clown": 1.5})
    rng = np.random.default_rng(size)
    words = ["You", "are", "an", "IDIOT!!", "a", "loweit,", "so", "w1th", "soooo", "###", "noise.", "cl0wn", "   ", "\n\n\n", "!!! ?!", "aaa"]
    for _ in range(40):
        text = " ".join(rng.choice(words, rng.integers(0, 120)))
        monkeypatch.setattr(toxicity, "_SLICE", 1 << 20)
        whole = toxicity.features(text, lexicon)
        monkeypatch.setattr(toxicity, "_SLICE", size)
        np.testing.assert_array_equal(whole, toxicity.features(text, lexicon))


def plain_features(text, weights, near=3):
    """The features by their definitions, without slices or arrays."""
    import math
    import re
    tokens = re.findall(r"\S+", text)
    best = [max([weights.get(t, 0.0) for t in toxicity.terms(toxicity.bare(w))], default=0.0) for w in tokens]
    you = [toxicity.bare(w) in toxicity.SECOND_PERSON for w in tokens]
    best = [0.0 if y else b for b, y in zip(best, you)]
    hits = [i for i, b in enumerate(best) if b]
    n, chars = max(len(tokens), 1), max(len(text), 1)
    met = {max(toxicity.terms(toxicity.bare(tokens[i])), key=lambda t: weights.get(t, 0.0)) for i in hits}
    close = sum(any(you[max(0, i - near):i + near + 1]) for i in hits)
    repeats = sum(len(m.group()) >= 3 for m in re.finditer(r"(.)\1*", text))
    return [math.log1p(len(tokens)), sum(best) / n, math.log1p(len(hits)), len(hits) / n, max(best, default=0.0), math.log1p(len(met)),
            sum(you) / n, close / max(len(hits), 1), sum(c.isupper() for c in text) / chars, sum(w.isupper() for w in tokens) / n,
            (len(re.findall(r"[!?]{2,}", text)) + text.count("!")) / n, sum(c in "#$%&*@^~_|<>=+" for c in text) / chars,
            len(toxicity._MIXED.findall(text)) / n, repeats / n]


def test_features_equal_their_definitions(spark, sf):
    weights = {"idiot": 3.0, "lowe-": 2.0, "the": 0.5}
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["", "you", "idiot you", "You IDIOT", "a b c d e f you idiot", "idiot a b c you", "idiot a b c d you", "aaa!!! ?? b4d", "\n\n\n\n"]
    lexicon = toxicity.Lexicon(weights)
    for t in texts:
        np.testing.assert_allclose(toxicity.features(t, lexicon), np.array(plain_features(t or "", weights), np.float32), rtol=1e-5, atol=1e-7)


def test_one_long_word():
    lexicon = toxicity.Lexicon({})
    word = "Ab1!" * 800_000
    found = dict(zip(toxicity.FEATURES, toxicity.features(word, lexicon)))
    assert found["words"] == np.float32(np.log1p(1)) and found["capitals"] == 0.25


def test_the_sample_is_bounded_by_texts(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "same")] * 50 + [(3, "clean words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, toxic int")
    drawn = toxicity._sample(docs, labels, "doc_id", "text", "toxic", 100, 13)
    assert drawn.count() == 100 and drawn.select("y", "text").distinct().count() == 100
    again = toxicity._sample(docs.repartition(7), labels, "doc_id", "text", "toxic", 100, 13)
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, again.collect()))
    assert toxicity._sample(docs, labels, "doc_id", "text", "toxic", 8000, 13).count() == 502


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0), (None, 1), (77, 1), (9, 0)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(no_docs, labels).count() == 0
    none = toxicity.toxicity(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}


def test_distinct_counts_all_hits():
    terms = {f"term{chr(97 + i // 20)}{chr(97 + i % 20)}": 1.0 + i / 1000 for i in range(200)}
    at = toxicity.FEATURES.index("distinct")
    for text in ("termaa " * 300 + " ".join(terms), " ".join(terms) + " termaa" * 300):
        assert np.isclose(toxicity.features(text, toxicity.Lexicon(terms))[at], np.log1p(200))
