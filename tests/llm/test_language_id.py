import zlib

import numpy as np
import pytest

from kilowatt.llm import language_id


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(docs):
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 5


def test_only_the_text_enters_a_prediction(docs, spark):
    model = language_id.train(docs)
    shuffled = docs.selectExpr("text", "'xx' AS lang", "1L AS doc_id")
    a = sorted(map(str, shuffled.select(language_id.predicted(shuffled, model, shuffled["text"])).collect()))
    b = sorted(map(str, docs.select(language_id.predicted(docs, model, docs["text"])).collect()))
    assert a == b


def test_training_is_repeatable(docs):
    a, b = language_id.train(docs), language_id.train(docs.repartition(5))
    assert a.langs == b.langs and np.array_equal(a.table, b.table) and a.threshold == b.threshold


def test_unknown_scripts_are_rejected(docs):
    model = language_id.train(docs)
    for text in ("Привет мир как дела сегодня", "你好世界这是一个句子", "γειά σου κόσμε τι κάνεις"):
        assert model.predict(text)[2]


@pytest.mark.parametrize("text", [None, "", "  \n", "123 45,6 !?", "🙂🙂"])
def test_no_letter_is_und(docs, text):
    assert language_id.train(docs).predict(text) == ("und", 0.0, True)


def plain_subwords(text):
    """Subwords as strings: letters lower-cased, one blank between and around words."""
    letter = lambda c: bool(language_id._IS_LETTER[min(ord(c), language_id._KNOWN)])
    out = " "
    for c in text.lower() + " ":
        if letter(c) or out[-1] != " ":
            out += c if letter(c) else " "
    return [out[i:i + n] for n in range(1, 5) for i in range(len(out) - n + 1)] if len(out) > 1 else []


@pytest.mark.parametrize("size", [1, 2, 5, 700])
def test_slices_change_nothing(monkeypatch, size):
    for text in ("Some words of a text, with 12 numbers and é. " * 50, "", "...", "x", " 1 a", "1 2 3 . a", "aé漢 b" * 30, "a" * 400, "end. !"):
        monkeypatch.setattr(language_id, "_SLICE", 1 << 20)
        whole = np.sort(np.concatenate([np.zeros(0, np.int32), *language_id.subwords(text)]))
        monkeypatch.setattr(language_id, "_SLICE", size)
        cut = np.sort(np.concatenate([np.zeros(0, np.int32), *language_id.subwords(text)]))
        assert np.array_equal(whole, cut), text
        plain = plain_subwords(text)
        assert len(plain) == len(whole)
        # equal subwords, equal buckets
        assert len(set(plain)) >= len(set(whole.tolist())) >= 0.98 * len(set(plain))


def test_a_word_of_three_million_letters():
    assert sum(map(len, language_id.subwords("x" * 2_400_000))) == 4 * 2_400_000 + 2


def test_odd_rows(odd_docs, no_docs):
    rows = {str(r["doc_id"]): r for r in language_id.identify(odd_docs).collect()}
    assert len(rows) == 12
    for i in ("3", "4", "5", "8"):
        assert rows[i]["lang_pred"] == "und" and rows[i]["rejected"]
    kept = language_id.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    assert not {"3", "4", "5", "8"} & {str(r["doc_id"]) for r in kept.collect()}
    assert language_id.identify(no_docs).count() == 0
    assert language_id.keep_identified(no_docs).count() == 0


def test_nothing_to_learn_from(odd_docs):
    from pyspark.sql import functions as F
    rows = language_id.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


def sampled(rows, **options):
    import inspect
    given = {k: p.default for k, p in inspect.signature(language_id.train).parameters.items()}
    given = {"rows": given["sample_rows"], "chars": given["sample_chars"], "lang_rows": given["lang_rows"], "seed": given["seed"]} | options
    return language_id._sample(rows, "text", "lang", **given)


def test_sample_is_drawn_over_distinct_texts_and_languages(spark):
    """2,500 copies, very long texts and a rare language: each still has its share."""
    rows = [("copied text of one language", "en")] * 2500 + [(f"text number {i} of many", "en") for i in range(5000)]
    rows += [("long words " * 100_000 + str(i), "fr") for i in range(25)] + [("rare language", "is")]
    rows = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    got = sampled(rows).distinct().collect()
    assert len([r for r in got if r["lang"] == "en"]) > 1900
    assert len([r for r in got if r["lang"] == "fr"]) == 25 and len([r for r in got if r["lang"] == "is"]) == 1
    assert max(len(r["text"]) for r in got) == 10_000
    assert language_id.train(rows).langs == ["en", "fr", "is"]


def test_copies_of_a_sampled_text_are_one_row(spark):
    rows = spark.createDataFrame([("copied text", "en")] * 4000 + [("other text", "en"), ("copied text", "fr")], "text string, lang string").repartition(5)
    got = sampled(rows).select("lang", "text").collect()
    assert sorted(map(tuple, got)) == [("en", "copied text"), ("en", "other text"), ("fr", "copied text")]
