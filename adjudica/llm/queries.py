"""Registered queries of the training-data operators: digests over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii
from .base import table
from .bestfit import pack_best_fit
from .bpe import decode_documents, encode_documents
from .counts import count_tokens
from .exact import exact_duplicates
from .near import Similarity, link_components
from .packing import pack_documents
from .quality import learn, score_documents
from .ranking import rank_documents
from .suffixes import remove_repeats
from .topk import top_inner_products
from .warc import archive_round_trip
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decode_documents(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, pii.learn(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"), Similarity(words=2))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_best_fit(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).drop("ids")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_topk_search": op7_topk_search,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_token_counts": op9_token_counts,
    "op10_web_archive": op10_web_archive,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) = doc_id AS kept,
               text_sha256
        FROM d""",
    "op7_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op10_web_archive": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
        FROM m""",
    "op13_ranked_search": r"""
        WITH words AS (
            SELECT doc_id, row_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT doc_id, text, row_number() OVER () AS row_id FROM documents)),
        asked AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY item_id, term),
        docs AS (SELECT row_id, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY row_id),
        corpus AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM docs),
        tf AS (
            SELECT row_id, term, count(*) AS tf FROM words
            WHERE term IN (SELECT term FROM asked) GROUP BY row_id, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM tf, corpus GROUP BY term, documents),
        scores AS (
            SELECT item_id, row_id, any_value(doc_id) AS doc_id,
                   CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN docs USING (row_id), corpus
            GROUP BY item_id, row_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
