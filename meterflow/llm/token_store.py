"""Token ids in files of separately compressed documents that share a dictionary.

A store is a folder with a manifest table and shard files. A shard holds the documents of
one range of ids, in ascending order:

    "MTOK" + version + bytes per id            (4 + 1 + 1 bytes)
    SHA-256 of the dictionary                  (32 bytes)
    one Zstandard frame per document
    doc ids (int64), whether null (uint8), frame ends (uint64), lengths (uint64)
    number of documents, place of the index    (2 * uint64) + "MTOK"

All integers are little-endian. To read one document, read its index entry and its frame.
The dictionary is trained on the serialised ids of a bounded sample and stored once, in a
table of one row beside the manifest; a reader compares its hash with each shard's.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import BATCH_ROWS, stored
from meterflow.llm.files import open_for_reading, open_for_writing
from meterflow.llm.word_tokens import WordTokens
from meterflow.session import scratch_path

MAGIC, VERSION = b"MTOK", 1
HEADER, FOOTER = struct.Struct("<4sBB32s"), struct.Struct("<QQ4s")
INDEX_ENTRY = 8 + 1 + 8 + 8
#: The dictionary: its size, and the documents and characters of each (from a hashed place on) that it is trained on.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_CHARS = 32_768, 2_000, 4_000
LEVEL = 3
#: Documents that are read in one go, and tasks at most for them; beyond, a task reads several slices.
SLICE_DOCS, MOST_TASKS = 20_000, 20_000


@dataclass(frozen=True)
class Layout:
    """What all shards of a store have in common."""

    id_bytes: int
    dictionary: bytes

    @property
    def digest(self) -> bytes:
        return sha256(self.dictionary).digest()

    @property
    def kind(self) -> str:
        return f"<u{self.id_bytes}"

    def compression(self):
        return zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None


class Store(NamedTuple):
    """A manifest with a row per shard, and the one row that all shards share."""

    manifest: DataFrame
    dictionary: DataFrame

    def layout(self) -> Layout:
        row = self.dictionary.first()
        return Layout(row.id_bytes, bytes(row.dictionary))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for such samples; too few of them give none (empty)."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def layout_for(docs: DataFrame, tokens: WordTokens, end: int) -> Layout:
    """Train the dictionary on the documents with the smallest hashes of their ids."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    piece = F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id"), spare) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rows = docs.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(piece).alias("text"))
    texts = [row.text or "" for row in sorted(rows.collect(), key=lambda row: row.doc_id)]
    width = 2 if max(tokens.library.get_vocab_size(), end + 1) <= 1 << 16 else 4
    samples = [np.append(ids, end).astype(f"<u{width}").tobytes() for ids in tokens.encode(texts)]
    return Layout(width, train_dictionary(samples))


def _write_shard(path_of, rows, layout: Layout, tokens: WordTokens, end: int) -> tuple[str, int, int, int] | None:
    """Write the batches of one task; the path, documents, ids and bytes written."""
    path, out, n, total = None, None, 0, 0
    ids_, nulls, ends, lengths = [], [], [], []
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=layout.compression())
    for batch in rows:
        if not batch.num_rows:
            continue
        if out is None:
            path, out = path_of()
            out.write(HEADER.pack(MAGIC, VERSION, layout.id_bytes, layout.digest))
            at = HEADER.size
        for doc_id, ids in zip(batch["doc_id"].to_pylist(), tokens.encode_column(batch["text"])):
            frame = packer.compress(np.append(ids, end).astype(layout.kind).tobytes())
            out.write(frame)
            at += len(frame)
            ids_.append(doc_id or 0)
            nulls.append(doc_id is None)
            ends.append(at)
            lengths.append(len(ids) + 1)
    if out is None:
        return None
    index = [np.array(ids_, "<i8"), np.array(nulls, "<u1"), np.array(ends, "<u8"), np.array(lengths, "<u8")]
    for column in index:
        out.write(column.tobytes())
    out.write(FOOTER.pack(len(ids_), at, MAGIC))
    out.close()
    return path, len(ids_), int(index[3].sum()), at + INDEX_ENTRY * len(ids_) + FOOTER.size


MANIFEST = "shard int, path string, docs bigint, ids bigint, bytes bigint"


def write_store(docs: DataFrame, tokens: WordTokens, end: int) -> Store:
    """Encode all documents and write them in the order of their ids.

    Null texts are empty ones; null ids come last; rows with equal ids are ordered by the
    hashes of their texts. An empty table gives no shards.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-store")
    layout = layout_for(docs.select("doc_id", "text"), tokens, end)
    shared = spark.sparkContext.broadcast((layout, tokens))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        layout, tokens = shared.value
        done = _write_shard(lambda: open_for_writing(folder, ".mtok"), batches, layout, tokens, end)
        if done:
            row = (TaskContext.get().partitionId(), *done)
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = [field.split()[0] for field in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    placed = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = stored(placed.mapInArrow(write, MANIFEST), "token-manifest")
    common = spark.createDataFrame([(layout.id_bytes, bytearray(layout.dictionary))], "id_bytes int, dictionary binary")
    return Store(manifest, stored(common, "token-dictionary"))


def _read_slice(path: str, first: int, last: int, layout: Layout) -> Iterator[tuple[int | None, bytes]]:
    """Ids of the documents from `first` up to `last` of a shard, as they are serialised."""
    with open_for_reading(path) as shard:
        magic, version, width, digest = HEADER.unpack(shard.read(HEADER.size))
        if (magic, version, width, digest) != (MAGIC, VERSION, layout.id_bytes, layout.digest):
            raise ValueError(f"{path}: not a shard of this store")
        shard.seek(shard.size() - FOOTER.size)
        n, index, _ = FOOTER.unpack(shard.read(FOOTER.size))

        def column(skip: int, kind: str, begin: int, stop: int) -> np.ndarray:
            size = np.dtype(kind).itemsize
            shard.seek(index + skip * n + begin * size)
            return np.frombuffer(shard.read((stop - begin) * size), kind)

        ids = column(0, "<i8", first, last)
        nulls = column(8, "<u1", first, last)
        ends = column(9, "<u8", max(first - 1, 0), last).tolist()
        if first == 0:
            ends.insert(0, HEADER.size)
        unpacker = zstandard.ZstdDecompressor(dict_data=layout.compression())
        shard.seek(ends[0])
        for doc_id, null, begin, stop in zip(ids.tolist(), nulls.tolist(), ends, ends[1:]):
            yield None if null else doc_id, unpacker.decompress(shard.read(stop - begin))


def read_document(path: str, place: int, layout: Layout) -> np.ndarray:
    """The ids of one document of a shard, reading nothing else than its index entry and frame."""
    ((_, packed),) = _read_slice(path, place, place + 1, layout)
    return np.frombuffer(packed, layout.kind)


def read_store(store: Store, with_ids: bool = False) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids_crc32` (and `ids`) of every document in a store's files.

    Slices of shards are dealt out by a number of tasks that grows with them. Only a shard's
    number and its count of ids meet in one place, to be summed up.
    """
    manifest = store.manifest
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("shard", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("start"))
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(SLICE_DOCS).cast("long")))
    number = manifest.agg(F.sum(F.ceil(F.col("docs") / SLICE_DOCS))).first()[0] or 1
    work = (
        manifest.join(starts, "shard")
        .withColumn("first", slices)
        .withColumn("last", F.least(F.col("first") + SLICE_DOCS, F.col("docs")))
        .repartitionByRange(min(number, MOST_TASKS), "shard", "first")
    )
    shared = manifest.sparkSession.sparkContext.broadcast(store.layout())
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                yield from _rows(task, shared.value)

    def _rows(task: dict, layout: Layout) -> Iterator[pa.RecordBatch]:
        start = task["start"] + _ids_before(task["path"], task["first"])
        rows: list[list] = [[] for _ in names]
        for doc_id, packed in _read_slice(task["path"], task["first"], task["last"], layout):
            ids = np.frombuffer(packed, layout.kind).astype("<u4")
            for column, value in zip(rows, (doc_id, start, len(ids), zlib.crc32(ids), ids.view("<i4"))):
                column.append(value)
            start += len(ids)
            if len(rows[0]) == int(BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)
                rows = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return work.mapInArrow(read, ddl)


def _ids_before(path: str, place: int) -> int:
    """Number of ids of a shard's documents before a place, from the index."""
    with open_for_reading(path) as shard:
        shard.seek(shard.size() - FOOTER.size)
        n, index, _ = FOOTER.unpack(shard.read(FOOTER.size))
        shard.seek(index + 17 * n)
        return int(np.frombuffer(shard.read(8 * place), "<u8").sum())
