"""Toxicity by compression distance: which of two dictionaries serves a text's windows better."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType

from meterflow.llm.common import crc_remainder, empty_if_null, stored
from meterflow.llm.compression_distance import Calibration, Gains, calibrate, train, windows

HOLDOUT, HELD_OUT = 5, 0
ACCEPT = 0.5


@dataclass(frozen=True)
class Sample:
    """What is learned from at most, and when a word counts as toxic text's own.

    Documents are those with the smallest hashes of their ids. Of each, `windows` windows
    from hashed places train; one document in `calibration` is kept back for calibrating.
    A word's contexts are its distinct neighbours, so copies of a text add none. It has to
    have `least` in toxic text, `ratio` times as many as its share of ordinary text lets expect.
    """

    toxic_docs: int = 4_000
    ordinary_docs: int = 8_000
    windows: int = 200
    ordinary_windows: int = 150_000
    words: int = 4_096
    calibration: int = 4
    least: int = 10
    ratio: float = 8.0


def _sampled(docs: DataFrame, labels: DataFrame, how: Sample) -> DataFrame:
    """`(toxic, kept_back, h, text)` of the documents to learn from, one row per id."""
    marks = labels.filter(F.col("toxic").isNotNull() & (crc_remainder(F.col("doc_id"), HOLDOUT) != HELD_OUT))
    marks = marks.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).alias("toxic"))
    known = stored(docs.select("doc_id").distinct().join(marks, "doc_id"), "labelled-ids")
    first = lambda mark, most: known.filter(mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = first(F.col("toxic"), how.toxic_docs).unionByName(first(~F.col("toxic"), how.ordinary_docs))
    # So many ids at most; texts are read once the ids are known.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    once = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "toxic", "text")).alias("t"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(how.calibration))
    rows = once.select(F.col("t.toxic"), (part == 0).alias("kept_back"), F.xxhash64("doc_id").alias("h"), F.col("t.text"))
    return stored(rows, "toxicity-sample")


def _training_windows(sample: DataFrame, most: int) -> DataFrame:
    @F.arrow_udf(ArrayType(BinaryType()))
    def cut(texts: pa.Array) -> pa.Array:
        found = [windows(text) for text in empty_if_null(texts)]
        chosen = [w if len(w) <= most else sorted(w, key=lambda x: (xxhash.xxh64_intdigest(x), x))[:most] for w in found]
        return pa.array(chosen, pa.list_(pa.binary()))

    return sample.filter(~F.col("kept_back")).select("toxic", F.explode(cut("text")).alias("window"))


#: Marks that are no part of a word.
MARKS = b".,!?;:\"'()[]{}<>*#&%$|-_"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A word and a hash of its neighbours, for each place."""
    for batch in batches:
        marks, found, hashes = [], [], []
        for mark, window in zip(batch["toxic"].to_pylist(), batch["window"].to_pylist()):
            words = [word.strip(MARKS) for word in window.split()]
            for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
                if len(word) >= 3:
                    marks.append(mark)
                    found.append(word)
                    hashes.append(xxhash.xxh64_intdigest(b" ".join((before, word, after))) >> 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(marks, pa.bool_()), pa.array(found, pa.binary()), pa.array(hashes, pa.int64())], ["toxic", "word", "context"]
        )


def _toxic_words(cut: DataFrame, how: Sample) -> dict[bytes, int]:
    """Words that toxic text has of its own, with the number of their contexts there."""
    contexts = cut.mapInArrow(_contexts, "toxic boolean, word binary, context long").distinct()
    counts = contexts.groupBy("word").agg(
        F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("ordinary")
    )
    counts = stored(counts, "word-contexts")
    toxic, ordinary = counts.agg(F.sum("toxic"), F.sum("ordinary")).first()
    share = (toxic or 0) / max(1, ordinary or 0)
    own = counts.filter((F.col("toxic") >= how.least) & (F.col("toxic") >= how.ratio * share * (F.col("ordinary") + 1)))
    return {bytes(r.word): r.toxic for r in own.orderBy(F.desc("toxic"), "word").limit(how.words).collect()}


Model = tuple[tuple[bytes, bytes], Calibration]


def learn(docs: DataFrame, labels: DataFrame, how: Sample = Sample()) -> Model | None:
    """Dictionaries and calibration from `labels.toxic` of documents that aren't held out; None unless both labels occur.

    A document labelled more than once counts as what most of its labels say (toxic if
    even); null labels and rows with a null id count for nothing.
    """
    sample = _sampled(docs, labels, how)
    cut = stored(_training_windows(sample, how.windows), "toxicity-windows")
    ordinary = cut.filter(~F.col("toxic")).select("window").orderBy(F.xxhash64("window"), "window").limit(how.ordinary_windows)
    base = [bytes(r.window) for r in ordinary.collect()]
    marks = {r.toxic for r in sample.filter("kept_back").select("toxic").distinct().collect()}
    if not base or len(marks) < 2:
        return None
    contents = train(base, _toxic_words(cut, how))

    @F.arrow_udf(BinaryType())
    def gains(texts: pa.Array) -> pa.Array:
        counted = Gains(contents)
        return pa.array([counted.of(windows(text)).tobytes() for text in empty_if_null(texts)], pa.binary())

    rows = sample.filter("kept_back").select("toxic", "h", gains("text").alias("gains")).collect()
    rows.sort(key=lambda row: (row.h, bytes(row.gains)))
    return contents, calibrate([np.frombuffer(row.gains, np.int8) for row in rows], np.array([row.toxic for row in rows]))


def score(spark: SparkSession, model: Model | None) -> Callable[[Column], Column]:
    """A function of the text: likelihood of a toxic label. Without labels of both kinds to learn from it is 0."""
    shared = spark.sparkContext.broadcast(model)
    counted: list[Gains] = []  # made once per task

    @F.arrow_udf(DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array(np.zeros(len(texts)))
        contents, calibration = shared.value
        if not counted:
            counted.append(Gains(contents))
        return pa.array([calibration.score(counted[0].of(windows(text))) for text in empty_if_null(texts)], pa.float64())

    return scored


def toxicity_scores(docs: DataFrame, labels: DataFrame, how: Sample = Sample()) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` of every row.

    Null and empty texts are scored like any text without toxic windows. A null id is not
    held out and not learned from; a repeated id is learned from once, with one of its texts.
    Repeated rows each get their row, equal texts equal scores. An empty table gives no
    rows; other columns are ignored.
    """
    found = score(docs.sparkSession, learn(docs, labels, how))(F.col("text"))
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), HOLDOUT) == HELD_OUT, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )
