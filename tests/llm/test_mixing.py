import re
from collections import defaultdict

import pytest

from kilowatt.llm import mixing


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def water_fill(sizes, weights=(1, 2, 3), cap=3):
    """Targets by clamping one round after the other."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in target]
        if not free:
            return target
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= cap * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: cap * sizes[s] for s in over}


def check(docs, plan):
    sizes = defaultdict(int)
    source = {}
    for r in docs:
        sizes[r["source"]] += size(r["text"])
        source[r["doc_id"]] = r["source"]
    target, taken = water_fill(dict(sizes)), defaultdict(int)
    assert len(plan) == len(docs)
    for r in plan:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["whole"] * r["size"] + r["extra"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2


def test_plan_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing.mix_plan(docs)
    check(docs.collect(), plan.collect())
    again = mixing.mix_plan(docs.repartition(7)).collect()
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, again))


def test_odd_rows(odd_docs):
    check(odd_docs.collect(), mixing.mix_plan(odd_docs).collect())


def test_small_sources_are_clamped(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a") for i in range(50)] + [(100, "w w", "b"), (101, "w", "c")], "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs).collect()
    check(docs.collect(), plan)
    assert {r["doc_id"]: r["taken"] for r in plan if r["doc_id"] >= 100} == {100: 6, 101: 3}


def test_mix_follows_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = {r["doc_id"]: r for r in mixing.mix_plan(docs).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    taken, whole = defaultdict(int), defaultdict(int)
    for r in out.collect():
        taken[r["doc_id"]] += size(r["text"])
        whole[r["doc_id"]] += r["text"] == text[r["doc_id"]]
        if r["text"] != text[r["doc_id"]]:
            assert text[r["doc_id"]].split()[:size(r["text"])] == r["text"].split()
    assert {i: p["taken"] for i, p in plan.items() if p["taken"]} == {i: n for i, n in taken.items() if n}
    assert all(whole[i] >= p["whole"] for i, p in plan.items() if p["size"])


def test_empty_table(no_docs):
    assert mixing.mix_plan(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_odd_rows_mixed(odd_docs):
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.mixed(odd_docs).count() >= 1


@pytest.mark.parametrize("id_", [None, 7])
def test_rows_without_an_id_of_their_own_are_dealt(spark, id_):
    rows = spark.createDataFrame([(id_, f"w{i} w", "a") for i in range(2000)], "doc_id long, text string, source string")
    sized = rows.selectExpr("doc_id AS id", "2L AS size", "xxhash64(text) AS mark", "2000L AS n_docs")
    assert sized.select(mixing.block_of(7, 128)).distinct().count() == 16
    check([{"doc_id": r["doc_id"], "text": r["text"], "source": "a"} for r in rows.collect()], mixing.mix_plan(rows).collect())
