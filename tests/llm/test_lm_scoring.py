import numpy as np

from kilowatt.llm import lm_scoring


def test_counts_cover_all_texts(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (6, 1), (2, 0)], "doc_id long, quality int")
    model = lm_scoring.train(lm_scoring.marked(odd_docs, labels))
    words = {r["doc_id"]: lm_scoring._WORD.findall((r["text"] or "").lower()) for r in odd_docs.collect()}
    everything = sum(len(lm_scoring._WORD.findall((r["text"] or "").lower())) for r in odd_docs.collect())
    target = len(words[1]) + len(words[6])
    assert model.totals[0, 0] == target
    assert np.isclose(model.scale, target / everything)
    slot = lm_scoring._SLOTS["hello"]
    held = sum(w.count("hello") for w in (words[1], words[2], words[11]))
    assert model.word_n[0, slot] == 1 and np.isclose(model.word_n[1, slot], held * model.scale)


def test_score_equals_the_formula(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "a b d"), (3, "x y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    m = lm_scoring.train(lm_scoring.marked(docs, labels))
    counts = {"t": [["a", "b", "a", "c"]], "b": [["a", "b", "a", "c"], ["a", "b", "d"], ["x", "y"]]}
    scale = 4 / 9

    def p(texts, weight, w, v, own):
        seqs = [["^", *t] for t in texts]
        one = lambda x: max(weight * (sum(s.count(x) for s in seqs) - own.count(x)), 0)
        own_pairs = list(zip(own, own[1:]))
        two = max(weight * (sum(list(zip(s, s[1:])).count((w, v)) for s in seqs) - own_pairs.count((w, v))), 0)
        total = max(weight * (sum(map(len, texts)) - len(own_pairs)), 0)
        share = (one(v) + 0.01) / (total + 0.01 * (1 << lm_scoring.WORD_BITS))
        return (two + 2.0 * share) / (one(w) + 2.0)

    own = ["^", "a", "b", "d"]
    want = np.mean([np.log(p(counts["t"], 1.0, w, v, []) / p(counts["b"], scale, w, v, own)) for w, v in zip(own, own[1:])])
    assert np.isclose(m.score("a b d")[0], want, rtol=1e-3)
    assert m.score("a b d")[1] == 3


def test_target_like_texts_score_higher(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        kind = i % 4 == 0
        words = [f"{'t' if kind else 'b'}{rng.integers(0, 40)}" if rng.random() < 0.6 else f"c{rng.integers(0, 40)}" for _ in range(80)]
        rows.append((i, " ".join(words), int(kind)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = lm_scoring.cross_entropy_difference(docs, docs.select("doc_id", "quality")).collect()
    score = {r["doc_id"]: r["score"] for r in got if r["held_out"]}
    kinds = {r[0]: r[2] for r in rows}
    assert min(s for i, s in score.items() if kinds[i]) > max(s for i, s in score.items() if not kinds[i])


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1), (7, 1)], "doc_id long, quality int")
    rows = {str(r["doc_id"]): r for r in lm_scoring.cross_entropy_difference(odd_docs, labels).collect()}
    assert len(rows) == 12
    assert all(np.isfinite(r["score"]) for r in rows.values())
    assert all(rows[i]["score"] == 0 and rows[i]["n_tokens"] == 0 for i in ("3", "4", "5"))
    assert lm_scoring.cross_entropy_difference(odd_docs, labels.limit(0)).count() == 13
    assert lm_scoring.cross_entropy_difference(no_docs, labels).count() == 0


def test_slices_see_every_token(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    whole = np.concatenate([lm_scoring.pairs(s) for s in lm_scoring.tokens(text)])
    monkeypatch.setattr(lm_scoring, "_SLICE", 64)
    assert np.array_equal(whole, np.concatenate([lm_scoring.pairs(s) for s in lm_scoring.tokens(text)]))


def test_own_counts_cover_all_slices(spark, monkeypatch):
    long = " ".join(f"own{i % 7} pair{i % 5}" for i in range(400))
    docs = spark.createDataFrame([(1, long), (2, "own1 other words"), (3, "pair2 more of them")], "doc_id long, text string")
    m = lm_scoring.train(lm_scoring.marked(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")))
    whole = m.score(long, True)
    monkeypatch.setattr(lm_scoring, "_SLICE", 64)
    assert np.isclose(m.score(long, True)[0], whole[0], atol=1e-6) and m.score(long, True)[1] == whole[1] == 800


def test_no_two_grams_share_a_count(spark):
    """More distinct words than any fixed table has slots: each is counted alone,
    and chunks of any size give the same scores."""
    n = 300_000
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(k * n // 20, (k + 1) * n // 20))) for k in range(20)] + [(20, "w1 w2 w3"), (21, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (20, 1)], "doc_id long, quality int")
    m = lm_scoring.train(lm_scoring.marked(docs, labels))
    assert (m.word_n[1] > 0).sum() == n + 1 and m.pair_n.shape[1] == n + 1
    assert np.isclose(m.word_n[1, lm_scoring._SLOTS["w7"]], m.scale) and np.isclose(m.word_n[1, lm_scoring._SLOTS["w2"]], 2 * m.scale)
    got = [{r["doc_id"]: r["score"] for r in lm_scoring.cross_entropy_difference(docs, labels, chunk_chars=c).collect()} for c in (1, 20_000_000)]
    assert got[0].keys() == got[1].keys() and all(np.isclose(got[0][i], got[1][i]) for i in got[0])
    known = {r["doc_id"] for r in labels.filter(lm_scoring.crc_fold("doc_id", 5) != 0).collect()}
    m = lm_scoring.train(lm_scoring.marked(docs, labels.filter(lm_scoring.crc_fold("doc_id", 5) != 0)))
    assert np.isclose(m.score("w1 w2 w3", 20 in known)[0], got[1][20])


def test_a_word_is_never_cut():
    assert len(lm_scoring.whole("ab" * 1_600_000, lm_scoring._Slots())) == 2  # the start mark and one word
    text = "one two " * 400_000
    assert len(lm_scoring.whole(text, lm_scoring._Slots())) == 800_001
