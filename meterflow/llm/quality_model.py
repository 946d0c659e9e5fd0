"""Quality scores from boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from meterflow.llm.boosted_trees import Boosting, Trees, train
from meterflow.llm.common import crc_remainder, empty_if_null, fresh
from meterflow.llm.document_statistics import NAMES, statistics

#: Labelled documents learned from at most: those with the smallest hashes of their ids.
SAMPLE_DOCS = 20_000
HOLDOUT, HELD_OUT = 4, 2
ACCEPT = 0.7


@F.arrow_udf(ArrayType(FloatType()))
def statistics_of(texts: pa.Array) -> pa.Array:
    rows = [statistics(text) for text in empty_if_null(texts)]
    return pa.array(rows, pa.list_(pa.float32()))


def learn(docs: DataFrame, labels: DataFrame, how: Boosting = Boosting()) -> Trees | None:
    """Trees fitted to `labels.quality` of documents that aren't held out, or None without any.

    A document labelled more than once counts as what most of its labels say (1 if even);
    null labels and rows with a null id count for nothing.
    """
    marks = labels.filter(F.col("quality").isNotNull() & (crc_remainder(F.col("doc_id"), HOLDOUT) != HELD_OUT))
    marks = marks.groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    # Only documents that exist count, and the smallest hashes of their ids are chosen before any text is read.
    known = docs.select("doc_id").distinct().join(marks, "doc_id")
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))  # so many rows at most
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "good", F.xxhash64("text").alias("h"), "text")
    # A repeated id counts once, with one of its texts.
    once = texts.groupBy("doc_id").agg(F.min(F.struct("h", "good", "text")).alias("t"))
    rows = once.select(F.col("t.good"), statistics_of("t.text").alias("x"), F.xxhash64("doc_id").alias("h"), "doc_id").collect()
    if not rows:
        return None
    rows.sort(key=lambda row: (row.h, row.doc_id))
    return train(np.array([row.x for row in rows], np.float32), np.array([row.good for row in rows], float), how)


def score(spark: SparkSession, trees: Trees | None) -> Callable[[Column], Column]:
    """A function of the text: likelihood of a good label. Without any label to learn from it is 1."""
    shared = spark.sparkContext.broadcast(trees)

    @F.arrow_udf(DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array(np.ones(len(texts)))
        rows = [statistics(text) for text in empty_if_null(texts)]
        return pa.array(shared.value.probabilities(np.array(rows, np.float32).reshape(-1, len(NAMES))))

    return scored


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` of every row.

    Null and empty texts are scored like any text without words. A null id is not held out
    and not learned from. Repeated rows each get their row, an empty table gives none, other
    columns are ignored.
    """
    found = score(docs.sparkSession, learn(docs, labels))(F.col("text"))
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), HOLDOUT) == HELD_OUT, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with an accepted score; exactly `ACCEPT` is accepted.

    Null and empty texts are scored like any text without words. Each row is judged by
    itself, so repeated rows share a fate and null ids don't matter. Without labels all stay.
    """
    (mark,) = fresh(docs, "_quality")
    found = docs.withColumn(mark, score(docs.sparkSession, learn(docs, labels))(F.col("text")))
    return found.filter(F.col(mark) >= ACCEPT).drop(mark)
