"""A corpus from raw documents to training sequences, in five stages of the library's operators.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet to the shared
folder and read back as the next one's documents. All but the last return the columns of
``documents``. Rows may have null or repeated ids; an empty table passes through every stage.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from branchledger.llm import exact_dedup, ngram_join, packing, quality_classifier, substring_dedup  # noqa: E402
from branchledger.llm.common import remainder, ship, written  # noqa: E402

#: Five words and a similarity of 0.8.
NEAR = ngram_join.Join(words=5, num=80, den=100)
LEAST_SCORE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from the labels' first fold."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality_classifier.train(docs.select("doc_id", "text"), labels, remainder("doc_id", 3) != 1)
    score = "score"
    while score.lower() in {c.lower() for c in docs.columns}:  # a column of that name stays the documents' own
        score += "_"
    return quality_classifier.score(docs, model, score_col=score).where(F.col(score) >= LEAST_SCORE).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    ship(spark)
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    ship(spark)
    return ngram_join.one_of_each(docs, NEAR)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat; ``n_chars`` follows the text."""
    ship(spark)
    cut = substring_dedup.without_repeats(docs, as_text=True)
    return cut.select("own.*", F.col("kept").alias("text")).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    ship(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("suffix_array_dedup", passages),
    ("best_fit_packing", sequences),
]

#: No stage but exact dedup can be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
