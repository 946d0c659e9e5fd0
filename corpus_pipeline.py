"""From raw documents to token ids, in stages that each work on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import bpe, language_id, mixing, quality_model, simhash_dedup
from meterflow.llm.common import prepare, read_table, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.in_known_language(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_dedup.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encoded_documents(docs, vocabulary)


STAGES: list[tuple[str, Stage]] = [
    ("languages", languages),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: The learned stages have no SQL; tests compare them with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written as Parquet and read again as the next one's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
