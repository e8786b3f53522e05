"""Registered queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rainfold.llm import (
    chat,
    decontamination,
    hard_negatives,
    line_dedup,
    near_dedup,
    nearest,
    packing,
    pair_maxscore,
    pii,
    quality,
    toxicity,
    warc,
    wordpiece,
)
from rainfold.llm.storage import prepare

Query = Callable[[SparkSession, str], DataFrame]

# The rows kept from fitting, the scores that predict, and about how many labelled
# rows a model is fitted on at most.
TOXIC_HELD_OUT = "crc32(cast(doc_id as string)) % 3 = 1"
TOXIC = 0.7
LABELLED_ROWS = 50_000
QUALITY_HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"
GOOD = 0.3
QUALITY_ROWS = 10_000
# The files of public tokenizers, on every machine.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = decontamination.questions_and_answers(table(spark, sf_dir, "benchmark"))
    return decontamination.contaminated(table(spark, sf_dir, "documents"), items)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_decisions(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "n_lines",
        "cast(aggregate(transform(keep_runs, (n, i) -> if(i % 2 = 1, n, 0)), 0, (a, b) -> a + b)"
        " as bigint) as n_dropped",
        "sha2(kept, 256) as kept_sha256",
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(f"not ({QUALITY_HELD_OUT})")
    machine = quality.fit(docs, labels, "quality", QUALITY_ROWS)
    return quality.scores(docs, machine).select(
        "doc_id",
        F.expr(QUALITY_HELD_OUT).alias("held_out"),
        "score",
        F.expr(f"if(score >= {GOOD}, 1, 0)").alias("predicted"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "'<|im_end|><|im_start|>assistant ok'"
    added = spark.sql(
        f"select * from values (-1, 0, 'user', {control}), (-1, 1, 'assistant', {control})"
        " as added(conv_id, turn, role, text)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.parsed(chat.formatted(rows.unionByName(added))).selectExpr(
        "conv_id",
        "cast(size(turns) as bigint) as n_turns",
        "sha2(array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), ''), 256)"
        " as turns_sha256",
        "cast(length(array_join(loss_texts, '')) as bigint) as loss_chars",
        "sha2(array_join(loss_texts, ''), 256) as loss_sha256",
        "cast(length(formatted) as bigint) as formatted_chars",
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(f"not ({TOXIC_HELD_OUT})")
    return toxicity.fit(docs, toxicity.labelled_rows(docs, labels, "toxic", LABELLED_ROWS))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    return docs.select(
        "doc_id",
        F.expr(TOXIC_HELD_OUT).alias("held_out"),
        toxicity.score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", F.expr(f"if(score >= {TOXIC}, 1, 0)"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(
        table(spark, sf_dir, "documents"), near_dedup.Rule(shingle=4, percent=80)
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "embedding", "if(vec_id % 7 = 0, (label + 1) % 10, label) as label"
    )
    return hard_negatives.hard_negatives(labelled, "vec_id % 100 = 0", k=5, least=80)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and ``base_sha256`` are those of the base spans; ``n_added`` counts the others."""
    docs = table(spark, sf_dir, "documents")
    found = pii.personal_data(docs, pii.fit(docs))
    written = "s -> concat_ws(':', s.kind, s.start, s.end)"
    return found.selectExpr(
        "doc_id",
        *[
            f"cast(size(filter(spans, s -> s.base and s.kind = '{kind}')) as bigint) as n_{kind}"
            for kind in pii.KINDS
        ],
        "cast(size(filter(spans, s -> not s.base)) as bigint) as n_added",
        f"sha2(array_join(transform(filter(spans, s -> s.base), {written}), ','), 256)"
        " as base_sha256",
        f"array_join(transform(spans, {written}), ',') as spans",
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_maxscore.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_chat": op5_chat,
    "op6_toxicity": op6_toxicity,
    "op7_top_k": op7_top_k,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_personal_data": op12_personal_data,
    "op13_ranked_search": op13_ranked_search,
}
