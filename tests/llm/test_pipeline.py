import hashlib
import re

import corpus_pipeline
from kilowatt.llm import bpe, language_id, mixing, simhash
from kilowatt.llm.queries import ORACLE, QUERIES, vocabulary


def test_run_equals_the_stages_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.train(docs.filter(language_id.crc_fold("doc_id", 3) != 1))
    rows = []
    for r in docs.collect():
        if not model.predict(r["text"])[2]:
            rows.append(r)
    best = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r)
    rows = sorted(best.values(), key=lambda r: r["doc_id"])
    prints, low = [simhash.simhash(r["text"]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = low[i], low[j]
                low = [min(a, b) if x in (a, b) else x for x in low]
    rows = [r for i, r in enumerate(rows) if low[i] == i]
    mix = mixing.mixed(spark.createDataFrame(rows, docs.schema)).collect()
    with open(vocabulary(), encoding="utf-8") as f:
        m = bpe.ByteBPE(f.read())
    want = []
    for r in mix:
        ids = m.encode(r["text"] or "").tolist()
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_stages_keep_the_columns(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd_docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_empty_documents_pass_through(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_registered():
    import __spark_entry__ as entry
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_queries_equal_their_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, sf)
        cols = sorted(got.columns)
        want = con.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(str(tuple(r)) for r in got.select(*cols).collect()) == sorted(map(str, want)), name
