"""Near-duplicate documents by SimHash fingerprints and a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from meterflow.llm.common import empty_if_null, fresh, stored
from meterflow.llm.components import components
from meterflow.llm.gray_index import GrayIndex

SHINGLE, SEED, RADIUS = 3, 42, 3
#: A group of fingerprints that one task searches; larger ones are split.
GROUP_LIMIT = 16_384
#: The search takes in whole groups until it has about so many rows.
CHUNK_ROWS = 200_000
#: Hashes whose bits are counted at once.
HASHES = 65_536
DEPTH = 4


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in more than half of the hashes of the word shingles; no words give 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    reach = min(shingle, len(words)) - 1
    begins, ends = (ends - lengths)[: len(words) - reach].tolist(), ends[reach:].tolist()
    del words
    ones = np.zeros(64, np.int64)
    for at in range(0, len(begins), HASHES):
        hashes = [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(begins[at : at + HASHES], ends[at : at + HASHES])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(begins), bitorder="little").view("<u8")[0])


def fingerprint_of(text: str, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf(LongType())
    def codes(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(text, shingle) for text in empty_if_null(texts)], np.uint64)
        return pa.array(values.view(np.int64))

    return codes(text)


def hex_digits(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def rank_of(code: Column) -> Column:
    """Gray rank, shifted so that signed numbers sort as unsigned ones."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _masks() -> tuple[list[int], list[list[int]]]:
    """Masks of bits that two fingerprints must share to meet in a group, and the masks that split each further.

    Bits not yet in a mask are cut into RADIUS + 1 blocks. Fingerprints within the radius
    differ in at most RADIUS of them, so they agree in at least one block, at every depth.
    """
    masks, children, last = [0], [[]], [0]
    for _ in range(DEPTH):
        made = []
        for parent in last:
            rest = [bit for bit in range(64) if not masks[parent] >> bit & 1]
            for part in range(RADIUS + 1):
                block = rest[part * len(rest) // (RADIUS + 1) : (part + 1) * len(rest) // (RADIUS + 1)]
                children[parent].append(len(masks))
                made.append(len(masks))
                masks.append(masks[parent] | sum(1 << bit for bit in block))
                children.append([])
        last = made
    return masks, children


MASKS, CHILDREN = _masks()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _groups(parent: Column) -> Column:
    """The groups that a fingerprint joins below a mask, as structs of the mask's number and the shared bits."""
    numbers = F.element_at(F.array(*[F.array(*[F.lit(c) for c in kids]) for kids in CHILDREN if kids]), parent + 1)
    masks = F.array(*[F.lit(_signed(m)) for m in MASKS])
    return F.transform(
        numbers, lambda n: F.struct(n.alias("mask"), F.col("code").bitwiseAND(F.element_at(masks, n + 1)).alias("bits"))
    )


def routed(codes: DataFrame) -> DataFrame:
    """`(mask, bits, code)`: every fingerprint in each group in which a partner may be; only sizes decide how deep."""
    entries = codes.select("code", F.explode(_groups(F.lit(0))).alias("g")).select("g.mask", "g.bits", "code")
    done = None
    for depth in range(1, DEPTH + 1):
        large = None
        if depth < DEPTH:
            sizes = entries.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n"))
            large = stored(sizes.filter(F.col("n") > GROUP_LIMIT).select("mask", "bits"), "large-groups")
        if large is None or large.isEmpty():
            return entries if done is None else done.unionByName(entries)
        kept = entries.join(large, ["mask", "bits"], "left_anti")
        done = kept if done is None else done.unionByName(kept)
        split = entries.join(large, ["mask", "bits"], "left_semi")
        entries = split.select("code", F.explode(_groups(F.col("mask"))).alias("g")).select("g.mask", "g.bits", "code")


def _links_of(chunk: pa.Table, radius: int) -> pa.RecordBatch:
    codes = chunk["code"].to_numpy().view(np.uint64)
    mask, bits = chunk["mask"].to_numpy(), chunk["bits"].to_numpy()
    new = np.append(True, (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) if len(codes) else np.zeros(0, bool)
    root = GrayIndex(codes, np.flatnonzero(new)).components(radius)
    linked = np.flatnonzero(root != np.arange(len(codes)))
    signed = codes.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[root[linked]])], ["a", "b"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut sorted batches into tables of whole groups."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            table = pa.Table.from_batches(held)
            mask, bits = table["mask"].to_numpy(), table["bits"].to_numpy()
            other = np.flatnonzero((mask != mask[-1]) | (bits != bits[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            rows -= cut
    if rows:
        yield pa.Table.from_batches(held)


def near_links(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links `(a, b)` between distinct fingerprints (column `code`) that connect all those within the radius.

    Of a group in which everything hangs together, links to one member suffice, so there are
    fewer links than rows whatever the group's size. Spark sorts each group by Gray rank.
    """
    if radius > RADIUS:
        raise ValueError(f"groups are cut for a radius of at most {RADIUS}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            yield _links_of(table, radius)

    placed = routed(codes).repartition("mask", "bits").withColumn("rank", rank_of(F.col("code")))
    ordered = placed.sortWithinPartitions("mask", "bits", "rank").drop("rank")
    return ordered.mapInArrow(search, "a long, b long")


def groups_of(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`(code, root, component_id)` for each distinct fingerprint of `prints` (`doc_id`, `code`)."""
    classes = prints.groupBy("code").agg(F.min("doc_id").alias("first_id"))
    roots = components(near_links(classes.select("code"), radius)).withColumnRenamed("node", "code")
    rooted = classes.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("code", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `fingerprint` and `component_id` of every row.

    Documents whose fingerprints differ in at most RADIUS bits are linked, and a component
    is named by its smallest id. Null and empty texts have fingerprint zero, linked like any
    other. Repeated rows each get their row. Null ids count for nothing in the smallest id
    (a component of null ids only has a null one). An empty table gives no rows; other
    columns are ignored.
    """
    prints = stored(docs.select("doc_id", fingerprint_of("text").alias("code")), "fingerprints")
    return prints.join(groups_of(prints), "code").select(
        "doc_id", hex_digits(F.col("code")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents, less all but one of every component: the one with the smallest id (nulls last) stays."""
    (key,) = fresh(docs, "_dedup_key")
    parts = (F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text").isNull().cast("string"), F.col("text"))
    identity = F.md5(F.concat_ws(":", *parts).cast("binary"))
    prints = stored(
        docs.select("doc_id", identity.alias("key"), fingerprint_of("text", shingle).alias("code")), "fingerprints"
    )
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    roots = groups_of(prints, radius).select("code", "root")
    classes = prints.groupBy("code").agg(F.min(order).alias("first"))
    kept = classes.join(roots, "code").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias(key))
    # Rows that repeat an id and a text have one key; one of them stays, and most go before the shuffle.
    return (
        docs.withColumn(key, identity)
        .join(kept, key)
        .dropDuplicates([key])
        .select(*[F.col(f"`{name}`") for name in docs.columns])
    )
