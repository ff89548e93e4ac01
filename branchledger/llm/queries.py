"""The registered queries of the operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchledger.llm import (
    alignment, bpe, exact_dedup, hard_negatives, language_id, licenses, ngram_join, packing, quality_classifier, quality_rules,
    stream_bpe, substring_dedup, warc,
)
from branchledger.llm.common import remainder, ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(modulus: int, value: int) -> Column:
    return F.coalesce(remainder("doc_id", modulus) == value, F.lit(False)).alias("held_out")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ngram_join.jaccard_classes(docs, ngram_join.Join(words=4, num=85, den=100))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return records.select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"), remainder("doc_id", 3) != 1)
    return quality_classifier.score(docs, model).select(
        "doc_id", _held_out(3, 1), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).select(
        "own.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.equal_classes(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.select("doc_id", "text", "lang"), remainder("doc_id", 5) != 0)
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", _held_out(5, 0), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).select("doc_id", "ids")
    return bpe.decode(ids, path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


def op11_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = stream_bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    return stream_bpe.decode(ids, path, decimal_col="decimal").select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decimal", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.integers("embedding").alias("components")
    )
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_warc, op3_quality_classifier, op4_best_fit_packing, op5_suffix_array_dedup,
        op6_exact_dedup, op7_language_id, op8_quality_rules, op9_byte_bpe, op10_license_scan,
        op11_stream_bpe, op12_hard_negatives, op13_token_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op2_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN firsts ON p.payload_digest = firsts.payload_digest""",
    "op6_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
               sha256(body) AS text_sha256
        FROM t""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS alike,
                   CAST(list_dot_product(a.c, v.c) AS BIGINT) AS score
            FROM v AS a, v WHERE a.vec_id % 100 = 0
        ),
        p AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike AND anchor_id <> other_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
