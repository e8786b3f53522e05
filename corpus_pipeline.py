"""From raw documents to packed training sequences: five stages of rainfold.llm in a row.

Each stage takes what its predecessor kept and, but for the last, returns the columns of documents:
toxic documents go, repeated lines go, one document of each group of near duplicates stays (the one
with the smallest doc_id; five-word shingles, similarity 0.8), documents that hold a benchmark item
go, and the rest is cut and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rainfold.llm import (
    decontamination,
    line_dedup,
    near_dedup,
    packing,
    queries,
    toxicity,
)
from rainfold.llm.storage import prepare, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(spark, docs, sf_dir)
    return docs.where(toxicity.score(F.col("text"), model) < queries.TOXIC)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.without_repeats(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = decontamination.questions_and_answers(queries.table(spark, sf_dir, "benchmark"))
    return decontamination.without_contaminated(docs, items)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, queries.TOKENIZER)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# A learned model's scores, connected components and a tokenizer's ids are out of SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
