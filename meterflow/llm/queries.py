"""One query per operator, over its whole table, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from meterflow.llm import (
    bpe,
    conversations,
    doc_fingerprints,
    hard_negatives,
    language_id,
    license_scan,
    mixing,
    quality_model,
    repetition,
    simhash_dedup,
    token_store,
    toxicity,
    warc,
)
from meterflow.llm.common import read_table
from meterflow.llm.word_tokens import WordTokens

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted_languages(read_table(spark, sf_dir, "documents"))


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf_dir, "documents"))
    due = [F.round(f"due_{n}", 6).alias(f"due_{n}") for n in range(1, mixing.MAX_PASSES + 1)]
    # In training order; a later pass is due after the first, and what is never due comes last.
    ordered = plan.orderBy(F.col("due_1").asc_nulls_last(), "doc_id")
    return ordered.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", *due)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encoded_documents(read_table(spark, sf_dir, "documents"), vocabulary, with_ids=False)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(read_table(spark, sf_dir, "pages")))


END_OF_DOCUMENT = 2


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        tokens = WordTokens(definition.read())
    return token_store.read_store(token_store.write_store(read_table(spark, sf_dir, "documents"), tokens, END_OF_DOCUMENT))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read_table(spark, sf_dir, "documents"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_fingerprints.document_fingerprints(read_table(spark, sf_dir, "documents"))


def op10_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    repairs = conversations.conversation_repairs(conversations.damaged(rows))
    return conversations.with_every_conversation(repairs, rows)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_simhash_near_dedup,
        op2_language_id,
        op3_mixing_sources,
        op4_quality_classifier,
        op5_byte_bpe,
        op6_warc,
        op7_token_ids,
        op8_license_scan,
        op9_document_fingerprints,
        op10_repetition_rules,
        op11_hard_negatives,
        op12_conversation_repair,
        op13_toxicity,
    )
}

SQL: dict[str, str] = {
    "op3_mixing_sources": mixing.SQL,
    "op6_warc": warc.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_conversation_repair": conversations.SQL,
}
