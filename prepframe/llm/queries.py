"""Registered queries of the numbered operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.llm.common import load, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle.strip()
        return fn

    return deco


SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op6_quality_rules",
    rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {SQL_WORDS} AS ws FROM d),
g AS (SELECT r, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] AS t
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
l AS (SELECT r, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
m AS (SELECT w.r, doc_id, text, ws, len(ws) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        len(ls) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w JOIN l USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines
    OR word_chars > 15 * n_words OR word_chars < 2 * n_words
    OR 10 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 4 * word_chars
    OR 2 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
    OR 10 * len([i FOR i IN range(2, len(ws) + 1) IF ws[i] = ws[i - 1]]) > 3 * n_words
    OR 10 * len([x FOR x IN ws IF regexp_matches(x, '\p{{L}}')]) < 4 * n_words) AS kept
FROM b
""",
)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm import quality as Q

    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return Q.apply_cascade(docs).select("doc_id", *Q.BASE_COLUMNS, "base_failed", "kept")


@query("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.jaccard import similarity_components

    return similarity_components(load(spark, sf_dir, "documents"), width=3, percent=90)


def _fold(n: int, k: int):
    """Rows whose crc32(doc_id as text) leaves the remainder k."""
    return F.crc32(F.col("doc_id").cast("string")) % n == k


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.toxicity import score_toxicity

    return score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), _fold(3, 1))


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.pu import positive_unlabelled

    return positive_unlabelled(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), _fold(5, 0))


@query("op5_bpe_encode_decode")
def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.bpe import decode, encode
    from prepframe.llm.tokens import tokenizer_path

    path = tokenizer_path("byte_bpe_50k.json")
    both = decode(encode(load(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.packing import pack
    from prepframe.llm.tokens import tokenizer_path

    return pack(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op9_bit_planes")
def op9_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.common import scratch_path
    from prepframe.llm.planes import read_documents, write_store
    from prepframe.llm.tokens import tokenizer_path

    out = scratch_path(spark, "token-planes")
    write_store(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), out)
    return read_documents(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_html_consensus")
def op10_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.html import extract_pages

    return extract_pages(load(spark, sf_dir, "pages"))


@query("op7_e8_lattice")
def op7_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.lattice import near_duplicates

    return near_duplicates(load(spark, sf_dir, "embeddings"), cosine=0.9)


@query("op1_pii_pseudonyms")
def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.pii import pseudonymise

    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs).select("doc_id", "text", "n_pii")


@query(
    "op11_warc_chunks",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha256(h) AS d FROM p),
m AS (SELECT d, min(page_id) AS low FROM q WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, q.d AS payload_digest,
  CASE WHEN n >= 100 AND low IS NOT NULL AND page_id IS DISTINCT FROM low THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM low THEN low END AS refers_to
FROM q LEFT JOIN m ON q.d = m.d
""",
)
def op11_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.common import scratch_path
    from prepframe.llm.warc import read_records, write_archives

    out = scratch_path(spark, "warc")
    write_archives(load(spark, sf_dir, "pages"), out)
    return read_records(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op12_segment_negatives",
    """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS al, v.vec_id, v.label, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a, v),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = al AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND label <> al
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
)
def op12_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.common import scratch_path
    from prepframe.llm.negatives import build_store, mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    store = scratch_path(spark, "segments")
    build_store(load(spark, sf_dir, "embeddings"), store, label=label)
    return mine(spark, store, F.col("vec_id") % 100 == 0)


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepframe.llm.repair import damage, repair

    return repair(damage(load(spark, sf_dir, "conversations")))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLE", "QUERIES", "load", "prepare", "query"]
