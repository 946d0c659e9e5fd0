"""Hard negatives of anchors, by exact integer inner products with all rows.

Rows are written once as files sorted by label. A unit of work is a block of anchors and one
of a fixed number of splits of the files: its task streams the split's tiles past the block,
multiplies them by Strassen's recursion and keeps a bounded heap per anchor. The heaps of
an anchor's splits are merged by an aggregate of bounded size. Positives come first (only
files with the block's labels are read), then the windows that they set.

So what is shuffled grows with the anchors alone, whatever the number of rows; only the
reading and the multiplication grow with both, as the task demands.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as dataset
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import stored
from meterflow.llm.strassen import product

#: Anchors of one block, and candidates of one tile.
BLOCK, TILE = 512, 2048
#: Rows of one file of candidates.
FILE_ROWS = 65_536
#: Splits of the files. A heap travels once per split, so their number is fixed.
SPLITS = 8


@dataclass(frozen=True)
class Mining:
    """Components become `floor(scale * x)`; a negative scores `low` to `high` percent of its positive."""

    scale: float = 256.0
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def usable(rows: DataFrame, vec_id: Column, label: Column, vector: Column, mining: Mining) -> DataFrame:
    """`(vec_id, label, q)` of the rows that take part, `q` in whole numbers."""
    slim = rows.select(vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * mining.scale))
    return slim.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & finite).select(
        "vec_id", "label", whole.alias("q")
    )


class Best:
    """A heap of bounded size per row: the highest scores, ties by smaller id, null ids last.

    An entry offered twice counts once. `floor` is the score that an offer has to reach.
    """

    def __init__(self, lowest: np.ndarray, size: int):
        self.size, self.floor = size, lowest.copy()
        self.row = self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def offer(self, row: np.ndarray, score: np.ndarray, id_: np.ndarray, null: np.ndarray) -> None:
        if not len(row):
            return
        row, score = np.append(self.row, row), np.append(self.score, score)
        id_, null = np.append(self.id, id_), np.append(self.null, null)
        order = np.lexsort((id_, null, -score, row))
        row, score, id_, null = row[order], score[order], id_[order], null[order]
        new = np.append(
            True, (row[1:] != row[:-1]) | (score[1:] != score[:-1]) | (id_[1:] != id_[:-1]) | (null[1:] != null[:-1])
        )
        row, score, id_, null = row[new], score[new], id_[new], null[new]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        full = place == self.size - 1
        self.floor[row[full]] = score[full]
        keep = place < self.size
        self.row, self.score, self.id, self.null = row[keep], score[keep], id_[keep], null[keep]


def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers as a matrix; shorter rows end in zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max(initial=0)))
    if len(values) and max(int(values.max()), -int(values.min())) >= (1 << 62):
        raise OverflowError("a component does not fit in 62 bits")
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)


def _tiles(files: list[str], labels: tuple[int, int] | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Ids, which ids are null, labels and vectors of the files' rows, tile by tile."""
    wanted = None if labels is None else (dataset.field("label") >= labels[0]) & (dataset.field("label") <= labels[1])
    for file in files:
        system, path = fs.FileSystem.from_uri(file)
        source = dataset.dataset(path, format="parquet", filesystem=system)
        for batch in source.to_batches(["vec_id", "label", "q"], filter=wanted, batch_size=TILE, batch_readahead=1):
            if batch.num_rows:
                yield *_ids(batch["vec_id"]), batch["label"].to_numpy(), _matrix(batch["q"])


def _scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of anchors and a tile of the rows; the longer vectors' further components meet zeros."""
    width = min(anchors.shape[1], vectors.shape[1])
    return product(anchors[:, :width], np.ascontiguousarray(vectors[:, :width].T))


def _positives(block: pa.RecordBatch, files: list[str], mining: Mining) -> pa.RecordBatch:
    ids, labels, anchors = block["vec_id"].to_numpy(), block["label"].to_numpy(), _matrix(block["q"])
    best = Best(np.full(len(ids), np.iinfo(np.int64).min), mining.positives)
    for tile_ids, null, tile_labels, vectors in _tiles(files, (int(labels.min()), int(labels.max()))):
        scores = _scores(anchors, vectors)
        fits = (labels[:, None] == tile_labels) & (null | (ids[:, None] != tile_ids)) & (scores >= best.floor[:, None])
        row, at = np.nonzero(fits)
        best.offer(row, scores[row, at], tile_ids[at], null[at])
    return pa.RecordBatch.from_arrays(
        [block["anchor"].take(pa.array(best.row)), pa.array(best.score), pa.array(best.id, mask=best.null)],
        ["anchor", "score", "vec_id"],
    )


def _negatives(block: pa.RecordBatch, files: list[str], mining: Mining) -> pa.RecordBatch:
    labels, anchors = block["label"].to_numpy(), _matrix(block["q"])
    slots, count = mining.positives, len(labels)
    # In Python's numbers, since a positive's score times a hundred may leave 64 bits.
    low, high = np.ones((count, slots), np.int64), np.zeros((count, slots), np.int64)
    for i, scores in enumerate(block["positive_scores"].to_pylist()):
        for k, score in enumerate(scores):
            low[i, k], high[i, k] = -(-mining.low * score // 100), mining.high * score // 100
    best = Best(low.ravel(), mining.negatives)
    for tile_ids, null, tile_labels, vectors in _tiles(files, None):
        scores = _scores(anchors, vectors)
        other = labels[:, None] != tile_labels
        for k in range(slots):
            floor = best.floor.reshape(count, slots)[:, k, None]
            row, at = np.nonzero(other & (scores >= floor) & (scores <= high[:, k, None]))
            best.offer(row * slots + k, scores[row, at], tile_ids[at], null[at])
    return pa.RecordBatch.from_arrays(
        [
            block["anchor"].take(pa.array(best.row // slots)),
            pa.array((best.row % slots).astype(np.int32)),
            pa.array(best.score),
            pa.array(best.id, mask=best.null),
        ],
        ["anchor", "slot", "score", "vec_id"],
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors, each serialized into one row."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def block(table: pa.Table) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        while rows >= BLOCK:
            table = pa.Table.from_batches(held)
            yield block(table.slice(0, BLOCK))
            held, rows = table.slice(BLOCK).to_batches(), rows - BLOCK
    if rows:
        yield block(pa.Table.from_batches(held))


def _searched(anchors: DataFrame, files: list[str], search, mining: Mining, schema: str) -> DataFrame:
    """What `search` finds for the blocks of anchors in every split of the files."""
    splits = [part for part in (files[n::SPLITS] for n in range(SPLITS)) if part]
    blocks = anchors.repartitionByRange(max(1, math.ceil(anchors.count() / BLOCK / 4)), "label", "anchor")
    blocks = blocks.sortWithinPartitions("label", "anchor").mapInArrow(_packed, "block binary")
    units = blocks.withColumn("split", F.explode(F.array(*[F.lit(n) for n in range(len(splits))])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, split in zip(batch["block"], batch["split"].to_pylist()):
                table = pa.ipc.open_stream(packed.as_buffer()).read_all().combine_chunks()
                yield search(table.to_batches()[0], splits[split], mining)

    # Every unit is much work, so they are dealt out one by one.
    number = max(1, math.ceil(anchors.count() / BLOCK) * len(splits))
    return units.repartition(min(number, 100_000)).mapInArrow(task, schema)


def hard_negatives(rows: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    `rows` has `vec_id`, `label` and `embedding`; `is_anchor` is a condition on `vec_id`. An
    anchor's positives are the best other rows of its label, its negatives the best rows of
    other labels in the window below each positive. Rows with a null label, a null vector, or
    a null or non-finite component take no part. A null id is no anchor, but may be found
    (last among ties). Rows that repeat an id and a score towards an anchor count once, an
    anchor that repeats id, label and vector too; rows of one id and other vectors are rows of
    their own, though none is a positive of another. Vectors of unequal length meet as if the
    shorter ended in zeros. Positives without negatives, and negative positives (whose window
    is empty), give no rows; nor does an empty table. Scores beyond 64 bits raise an error.
    Other columns are ignored.
    """
    spark = rows.sparkSession
    number = max(1, math.ceil(rows.count() / FILE_ROWS))
    slim = usable(rows, F.col("vec_id"), F.col("label"), F.col("embedding"), mining)
    # Sorted by label, so that files and their row groups hold few labels each.
    placed = slim.repartitionByRange(number, "label", "vec_id").sortWithinPartitions("label", "vec_id")
    candidates = stored(placed, "candidates")
    files = candidates.inputFiles()
    chosen = candidates.filter(is_anchor & F.col("vec_id").isNotNull()).dropDuplicates(["vec_id", "label", "q"])
    anchors = stored(chosen.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    if not files or anchors.isEmpty():
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )

    first = F.struct((-F.col("score")).alias("s"), F.col("vec_id").isNull().alias("n"), F.col("vec_id").alias("id"))
    best = lambda size: F.slice(F.sort_array(F.collect_set(first)), 1, size)
    found = _searched(anchors, files, _positives, mining, "anchor long, score long, vec_id long")
    positives = stored(found.groupBy("anchor").agg(best(mining.positives).alias("best")), "positives")
    armed = anchors.join(positives, "anchor").withColumn("positive_scores", F.transform("best", lambda b: -b["s"]))
    found = _searched(
        stored(armed.drop("best"), "armed-anchors"), files, _negatives, mining,
        "anchor long, slot int, score long, vec_id long",
    )
    negatives = found.groupBy("anchor", "slot").agg(best(mining.negatives).alias("found"))
    named = anchors.select("anchor", F.col("vec_id").alias("anchor_id")).join(positives, "anchor")
    listed = negatives.join(named, "anchor").withColumn("positive", F.element_at("best", F.col("slot") + 1))
    return listed.select("anchor_id", "positive", F.posexplode("found").alias("place", "negative")).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        (F.col("place") + 1).alias("rank"),
        F.col("negative.id").alias("negative_id"),
        (-F.col("positive.s")).alias("positive_score"),
        (-F.col("negative.s")).alias("negative_score"),
    )


SQL = r"""
WITH slim AS (
    SELECT DISTINCT vec_id::BIGINT AS vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT DISTINCT a.vec_id AS anchor_id, a.label = c.label AS alike, c.vec_id AS id,
           list_inner_product(a.q, c.q)::BIGINT AS score
    FROM slim a JOIN slim c ON a.label <> c.label OR a.vec_id IS DISTINCT FROM c.vec_id
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id NULLS LAST) <= 5)
SELECT p.anchor_id, p.positive_id, n.id AS negative_id, p.positive_score, n.score AS negative_score,
       (row_number() OVER best)::INTEGER AS rank
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
     AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id, p.positive_score ORDER BY n.score DESC, n.id NULLS LAST)
QUALIFY row_number() OVER best <= 10
"""
