"""Registered queries of the pipeline operators, with production parameters,
each over the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatt.llm import bpe, collocations, conversations, exact_dedup, language_id, lattice_dedup, lm_scoring, mixing, sharding, simhash, toxicity, url_filter, warc
from kilowatt.llm.shared import read
from kilowatt.session import scratch_path


def vocabulary() -> str:
    """Path of the public byte-level BPE vocabulary, on the driver."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.cross_entropy_difference(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op7_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_vectors(read(spark, sf_dir, "embeddings"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, payloads=False).drop("url")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_hex(simhash.near_duplicates(read(spark, sf_dir, "documents")))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read(spark, sf_dir, "documents")).withColumns({
        "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_bpe": op5_bpe,
    "op6_language_id": op6_language_id,
    "op7_lattice_dedup": op7_lattice_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_sharding": op11_sharding,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

# digit i of 32: five bits of the 160, taken from the two hex digits that hold them
_NIBBLE = "(instr('0123456789abcdef', substr(hex, {0} + 1, 1)) - 1)"
_BASE32 = ("substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((("
           + _NIBBLE.format("((i * 5) // 4)") + " * 16 + CASE WHEN (i * 5) // 4 + 1 < 40 THEN " + _NIBBLE.format("((i * 5) // 4 + 1)")
           + " ELSE 0 END) // CAST(pow(2, 3 - (i * 5) % 4) AS BIGINT)) % 32 AS BIGINT), 1)")

ORACLE = {
    "op4_exact_dedup": f"""
WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n""",
    # brute force over all pairs of a label; components by repeated reach
    "op7_lattice_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (
  SELECT a AS id, b AS reached FROM l UNION SELECT r.id, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT id, min(reached) AS low FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(c.low, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(c.low, v.vec_id)) AS kept
FROM v LEFT JOIN c ON c.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id""",
    # sha1 stands for the payload: sha1(blob) is hexadecimal, base32 is spelt out below
    "op9_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT page_id, payload, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
h AS (SELECT *, sha1(payload) AS hex FROM f),
d AS (SELECT *, list_aggregate(list_transform(range(32), lambda i: {_BASE32}), 'string_agg', '') AS payload_digest FROM h)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d""",
    "op12_collocations": """
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
s AS (SELECT lang, w, unnest(range(1, 6)) AS n FROM w),
g AS (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM s),
f AS (SELECT lang, n AS size, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE size >= 2 AND f >= 100),
kept AS (SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c q WHERE q.lang = c.lang AND q.size > c.size AND 100 * q.f >= 100 * c.f
    AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))),
k AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, size, unnest(range(1, size)) AS k FROM kept),
cut AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, total.n,
        (CAST(1000 AS HUGEINT) * k.a * total.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
    FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ')
    JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:k.size], ' ')
    JOIN total ON total.lang = k.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000""",
}
