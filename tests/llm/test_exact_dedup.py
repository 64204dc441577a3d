import hashlib
import re

from pyspark.sql import functions as F

from kilowatt.llm import exact_dedup


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(docs):
    groups = {}
    for r in docs:
        groups.setdefault(norm(r["text"]), []).append(r["doc_id"])
    out = []
    for r in docs:
        ids = groups[norm(r["text"])]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((r["doc_id"], keep, len(ids), r["doc_id"] == keep, hashlib.sha256(norm(r["text"]).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows_equal_brute_force(odd_docs):
    assert got(exact_dedup.exact_groups(odd_docs)) == expected(odd_docs.collect())


def test_all_documents_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(exact_dedup.exact_groups(docs)) == expected(docs.collect())


def test_texts_that_share_a_hash_stay_apart(odd_docs):
    clash = exact_dedup.exact_groups(odd_docs, content_hash=lambda c: F.lit("same"))
    assert got(clash) == expected(odd_docs.collect())


def test_copies_go_and_rows_stay_whole(odd_docs):
    kept = exact_dedup.drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    # 4 repeats the empty text of 3, 7 the long text of 6; both rows of 9 are one document
    assert ids == sorted([1, 2, 3, 5, None, 6, 8, 9, 9, 10, 11], key=str)


def test_empty_table(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_exact_copies(no_docs).count() == 0
