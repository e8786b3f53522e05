"""The registered queries at the smallest scale: against DuckDB, or for their contract's columns."""

import os

import pytest

import corpus_pipeline
from rainfold.llm import oracle, queries
from tests.oracle_compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

COLUMNS = {
    "op3_quality": ["doc_id", "held_out", "score", "predicted"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op9_token_counts": ["doc_id", "n_words", "n_tokens"],
}


@pytest.mark.parametrize("name", oracle.ORACLE_SQL)
def test_against_sql(spark, name):
    statement = oracle.ORACLE_SQL[name]
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], statement) is None


@pytest.mark.parametrize("name", COLUMNS)
def test_a_row_for_each_document(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[name] and found.count() == 200


def test_pipeline_equals_its_stages_one_by_one(spark):
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    docs, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns
        kept.append({r.doc_id for r in after.select("doc_id").collect()})
        docs = spark.createDataFrame(after.collect(), docs.schema)
    for before, after in zip(kept, kept[1:]):
        assert after <= before
    assert {r.doc_id for r in packed} == kept[-1]
