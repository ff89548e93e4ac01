"""The pipeline's stages against brute force, and its queries' columns."""

from collections import Counter

import corpus_pipeline
import pytest
from branchledger.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F
from test_copies import cut, linked_classes, normal


def test_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "suffix_array_dedup", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = corpus_pipeline.quality(spark, docs, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert good.columns == docs.columns
    assert sum(labels.get(i) == 1 for i, _ in rows) >= 0.97 * sum(q == 1 for q in labels.values())
    once = corpus_pipeline.exact(spark, good, sf_dir).cache()
    first = {}
    for i, t in sorted(rows):
        first.setdefault(normal(t), i)
    assert sorted(r.doc_id for r in once.collect()) == sorted(first.values())
    single = corpus_pipeline.near(spark, once, sf_dir).cache()
    kept = [(r.doc_id, r.text) for r in once.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for (i, _, low, n) in linked_classes(kept, 5, 80, 100) if n == 0 or i == low)
    clean = corpus_pipeline.passages(spark, single, sf_dir).cache()
    assert clean.columns == docs.columns
    want = Counter((i, kept.decode("utf-8", "ignore")) for (i, *_, kept) in cut([(r.doc_id, r.text) for r in single.collect()], 200))
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == want
    last = corpus_pipeline.sequences(spark, clean, sf_dir).collect()
    assert {r.doc_id for r in last} == {i for i, _ in want}


def test_stages_of_odd_rows(spark, odd, empty, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).collect() == []
    docs = odd
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, sf_dir)
        assert name == "best_fit_packing" or docs.columns == odd.columns
    assert docs.count() > 0


def test_quality_stage_keeps_columns_that_have_its_names(spark, odd, sf_dir):
    docs = odd.withColumns({"quality_score": F.lit("own"), "score_": F.lit(7)})
    got = corpus_pipeline.quality(spark, docs, sf_dir)
    assert got.columns == docs.columns
    rows = Counter(map(tuple, docs.collect()))
    assert not Counter(map(tuple, got.collect())) - rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, sf_dir)
    assert sorted(want.columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(want.columns).collect())) == Counter(map(tuple, want.fetchall()))
