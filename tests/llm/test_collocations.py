import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kilowatt.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words=5, least=100, top=2000):
    """Every n-gram counted one by one, every cut and every longer candidate looked at."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, words + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = []
    for (lang, p), a in cand.items():
        if any(q[0] == lang and len(q[1]) > len(p) and 100 * b >= 100 * a and any(q[1][i:i + len(p)] == p for i in range(len(q[1])))
               for q, b in cand.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_texts(seed=3, n=60):
    rng = random.Random(seed)
    pool = ["the", "The", "of", "a", "new", "york", "times", "São", "中文", "x\x1cy", "u v", "\x00", "été"]
    text = lambda: "".join(rng.choice(pool) + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "! ", "\x0b"]) for _ in range(rng.randrange(120)))
    rows = [(rng.choice(["en", "fr", None, "und", ""]), text()) for _ in range(n)]
    return rows + rows[:20] + [("en", None), (None, ""), ("fr", " \t ")]


@pytest.mark.parametrize("least", [2, 5])
def test_equals_brute_force(spark, least):
    rows = some_texts()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert rows_of(C.collocations(docs, least=least, modulus=3)) == brute(rows, least=least)


def test_top_ties_and_shorter_phrases(spark):
    rows = some_texts(5)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(C.collocations(docs, words=3, least=2, top=7)) == brute(rows, 3, 2, 7)


def test_sf_table_at_the_query_s_parameters(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text")
    assert rows_of(C.collocations(docs)) == brute([tuple(r) for r in docs.collect()])


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(C.collocations(odd_docs)) == brute(rows)
    assert C.collocations(no_docs).count() == 0


def entries(rows, size, modulus=4, longest=1024):
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([(r[1] or "").encode() for r in rows])], names=["lang", "text"])
    out = Counter()
    for b in C._parsed(iter([batch]), 4, modulus, longest, size):
        out.update(zip(*(c.to_pylist() for c in b.columns)))
    return out


@pytest.mark.parametrize("modulus, longest", [(4, 1024), (7, 9), (1 << 40, 5)])
def test_chunks_do_not_depend_on_slices(modulus, longest):
    rng = random.Random(1)
    rows = [("en", " ".join(rng.choice("abcdefg,.") for _ in range(4000))), ("fr", "same " * 3000), ("en", "w" * 5000), ("en", ". , ;")]
    whole = entries(rows, 1 << 30, modulus, longest)
    for size in (1, 17, 300, 4001):
        assert entries(rows, size, modulus, longest) == whole


def test_chunks_overlap_and_cover_the_text():
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefg,.") for _ in range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text.encode()])], names=["lang", "text"])
    chunks = [c for b in C._parsed(iter([batch]), 4, 8, 1024, 1 << 30) for c in b.column(1).to_pylist()]
    joined = chunks[0].split(" ")
    for a, b in zip(chunks, chunks[1:]):
        assert a.split(" ")[-4:] == b.split(" ")[:4]
        joined += b.split(" ")[4:]
    assert joined == C._normal(text.encode()).decode().split() and len(chunks) > 100


@pytest.mark.parametrize("n", [1, 4, 5, 8, 1024, 1025, 1026, 1027, 1028, 2049])
def test_short_rests_of_texts_without_a_trigger(n):
    """What the last regular cut leaves of a text may be shorter than the overlap."""
    text = ("same " * n).strip()
    for longest in (4, 1024):
        chunks = entries([("en", text)], 1 << 30, 1 << 40, longest)
        k = sorted(chunks)
        entry = pa.RecordBatch.from_arrays([pa.array(["en"] * len(k)), pa.array([c[1] for c in k]), pa.array([c[2] for c in k]),
                                            pa.array([chunks[c] for c in k], pa.int64())], names=["lang", "chunk", "last", "count"])
        found = Counter()
        for b in C._count(iter([entry]), (1, 2, 3, 4, 5), None, None, 15, 4, 1 << 20):
            found.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
        assert found == {" ".join(["same"] * size) + "\ten": n - size + 1 for size in range(1, 6) if size <= n}


def test_long_repeats_equal_brute_force(spark):
    rows = [("en", "same " * n) for n in (1025, 1026, 1027, 2050)] + [("fr", "The cat sat on the mat " * 171), (None, "a b " * 513)]
    assert rows_of(C.collocations(spark.createDataFrame(rows, "lang string, text string"))) == brute(rows)


def test_shared_passages_become_one_entry(spark):
    rng = random.Random(8)
    passage = " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(400))
    docs = spark.createDataFrame([("en", f"own{i} start{i} {passage} end{i} here{i}") for i in range(50)], "lang string, text string")
    found = C.dictionary(docs, modulus=8)
    assert found.filter("count = 50").count() >= 20
    assert found.select(F.sum(F.size(F.split("chunk", " ")) * F.col("count"))).first()[0] > 3 * found.select(F.sum(F.size(F.split("chunk", " ")))).first()[0]


def test_filters_that_let_all_or_little_through_change_nothing(spark):
    rows = some_texts(9)
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows, least=3)
    for bits in (15, 20):
        assert rows_of(C.collocations(docs, least=3, bits=bits)) == want
    everything = np.packbits(np.ones(1 << 15, bool))
    chunks = C.dictionary(docs)
    free = C.counted(chunks, (3, 4, 5)).filter("f >= 3")
    full = C.counted(chunks, (3, 4, 5), everything, everything, 15).filter("f >= 3")
    assert sorted(map(tuple, free.collect())) == sorted(map(tuple, full.collect()))


def test_small_blocks_add_up(spark):
    rows = some_texts(4)
    chunks = C.dictionary(spark.createDataFrame(rows, "lang string, text string"))
    a, b = (sorted(map(tuple, C.counted(chunks, (1, 2, 3, 4, 5), tokens=t).collect())) for t in (1, 1 << 20))
    assert a == b


def test_exact_arithmetic(spark):
    f = [("a", 1, 9 * 10**14), ("b", 1, 9 * 10**14), ("a b", 2, 9 * 10**14 - 1)]
    frequent = spark.createDataFrame([("en", *r) for r in f], "lang string, phrase string, n int, f long")
    totals = spark.createDataFrame([("en", 8 * 10**15 + 7)], "lang string, total long")
    r = C.scored(frequent, totals).first()
    assert r["score"] == 1000 * (9 * 10**14 - 1) * (8 * 10**15 + 7) // (9 * 10**14) ** 2
