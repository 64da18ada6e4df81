"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe_codec,
    conversations,
    fingerprint,
    jaccard,
    language,
    merge_rounds,
    packing,
    quality,
    secret_scan,
    target_resampling,
    token_counts,
    token_files,
    warc,
)
from millrace.llm.runtime import documents, ready
from millrace.llm.tokens import tokenizer_path

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


@_query
def op1_warc(spark, sf_dir):
    """Every page through WARC archives and back."""
    return warc.warc_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@_query
def op2_bpe_codec(spark, sf_dir):
    """Ids and decoded bytes of every text, as digests."""
    import public_tokenizers

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    return bpe_codec.bpe_round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@_query
def op3_fingerprints(spark, sf_dir):
    """Fingerprints of every text, its edited text and its neighbour."""
    return fingerprint.fingerprints(documents(spark, sf_dir))


@_query
def op4_jaccard(spark, sf_dir):
    """Components of near-equal documents."""
    return jaccard.jaccard_components(documents(spark, sf_dir))


@_query
def op5_packing(spark, sf_dir):
    """All documents in sequences of 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


@_query
def op6_language(spark, sf_dir):
    """The language of every text, learned from the documents that are not held out."""
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit_profiles(docs))


@_query
def op7_token_files(spark, sf_dir):
    """All token ids through patched frame-of-reference files and back."""
    return token_files.token_file_round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


@_query
def op8_quality(spark, sf_dir):
    """Statistics and verdict of every text, by trees fitted to the labels."""
    docs = documents(spark, sf_dir)
    trees = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_report(docs, trees)


@_query
def op9_token_counts(spark, sf_dir):
    """Token counts of every text."""
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


@_query
def op10_secrets(spark, sf_dir):
    """Secrets in every text."""
    docs = documents(spark, sf_dir)
    return secret_scan.secret_report(docs, secret_scan.fit_models(docs))


@_query
def op11_conversations(spark, sf_dir):
    """Every conversation, damaged by a fixed rule and repaired."""
    return conversations.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@_query
def op12_resampling(spark, sf_dir):
    """All documents scored by their likeness to the benchmark, the best tenth ranked."""
    return target_resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_query
def op13_sentencepiece(spark, sf_dir):
    """Sentencepiece ids and decoded text of every document, as digests."""
    return merge_rounds.piece_round_trip(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


ORACLE_SQL = {
    "op12_resampling": r"""
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step:
                   CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), words AS (
            SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
        ), counts AS (
            SELECT side, id, word, count(*) AS n FROM (SELECT side, id, unnest(w) AS word FROM words) GROUP BY ALL
        ), buckets AS (
            SELECT word, xor(list_reduce(
                   [4294967295] || list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT),
                   lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT word FROM counts), crc_table
        ), histogram AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
            FROM counts JOIN buckets USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1) * (total_s + 10000))::DOUBLE / ((s + 1) * (total_t + 10000))::DOUBLE))::BIGINT AS gain
            FROM histogram, (SELECT sum(s) AS total_s, sum(t) AS total_t FROM histogram)
        ), weights AS (
            SELECT id, sum(n * gain) AS weight FROM counts JOIN buckets USING (word) JOIN gains USING (bucket)
            WHERE side = 'd' GROUP BY id
        ), scores AS (
            SELECT id AS doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln(
                   (('0x' || substr(sha256('2024:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
            FROM words LEFT JOIN weights USING (id) WHERE side = 'd'
        ), places AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scores WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN place <= 10 * n // 100 THEN place END AS rank
        FROM scores LEFT JOIN places USING (doc_id)
    """,
    "op4_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
    """,
    "op1_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM payloads LEFT JOIN firsts USING (payload_digest)
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
