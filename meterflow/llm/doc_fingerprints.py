"""Document fingerprints: SimHash of weighted terms, and a search by permuted block tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from meterflow.llm.common import BATCH_ROWS, stored

BITS, RADIUS = 64, 3
#: Fingerprints are cut into so many blocks, up to so many fingerprints; the more there are, the longer keys have to be.
BLOCKS = ((1 << 22, 4), (1 << 30, 5), (1 << 62, 6))
#: Leading bits by which the tables' entries are dealt out.
DEALT = 16
#: A term is so many neighbouring words; one that occurs t times weighs SCALE * (1 + log2 t), rounded.
TERM, SCALE = 2, 16
#: Terms whose votes are counted at once, and fingerprint pairs compared at once.
VOTES, PAIRS = 65_536, 1 << 20
#: A table's entries under one key are dealt out in parts of about so many.
PART = 100_000
#: Ids are cut into ranges of about so many bytes of text, at least so many per shuffle partition. A range is a row on
#: the driver; beyond the last number (some 6 TB of text) they grow instead.
RANGE_BYTES, RANGES, MOST_RANGES = 64 << 20, 2, 100_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def term_hashes(text: str) -> np.ndarray:
    """Hashes of the terms in order, repeats included; fewer words than a term has are one term."""
    words = text.lower().encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int64, len(words))
    values = np.fromiter(map(xxhash.xxh64_intdigest, seen), np.uint64, len(seen))[ids]
    width = min(TERM, len(words))
    hashes = values[: len(values) - width + 1]
    for i in range(1, width):
        hashes = (hashes ^ (hashes >> np.uint64(32))) * MULTIPLIER + values[i : len(values) - width + 1 + i]
    hashes = (hashes ^ (hashes >> np.uint64(29))) * MULTIPLIER
    return hashes ^ (hashes >> np.uint64(32))


def fingerprint(text: str) -> int:
    """Every term votes with its weight for its hash's bits that are one and against the others; no terms give 0."""
    terms, counts = np.unique(term_hashes(text), return_counts=True)
    weights = np.rint(SCALE * (1 + np.log2(counts)))  # whole numbers, so sums don't depend on their order
    votes = np.full(BITS, -weights.sum())
    for at in range(0, len(terms), VOTES):
        bits = np.unpackbits(terms[at : at + VOTES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += 2 * (weights[at : at + VOTES] @ bits.astype(np.float64))
    return int(np.packbits(votes > 0, bitorder="little").view("<u8")[0])


def likeness(a: int, b: int) -> float:
    """Share of equal bits."""
    return 1.0 - (a ^ b).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the beginning of another."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def _ranges(docs: DataFrame) -> np.ndarray:
    """Ids that cut the table into ranges of about equal size, as many as its bytes ask for."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_RANGES, max(least, size // RANGE_BYTES))
    cuts = docs.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 0.2 / wanted)
    return np.unique(np.array(cuts, np.float64))


def _range_of(doc_id: Column, cuts: np.ndarray) -> Column:
    """Number of the range of an id; null ids are in the last."""

    @F.arrow_udf(IntegerType())
    def place(ids: pa.Array) -> pa.Array:
        values = ids.cast(pa.float64(), safe=False).fill_null(np.inf).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(cuts, values, side="right").astype(np.int32))

    return place(doc_id)


def beside_next(docs: DataFrame) -> DataFrame:
    """The documents (`range`, `ahead`, `doc_id`, `h`, `text`) dealt out so that every one lies right before the next.

    Ranges of ids are dealt to tasks and sorted there. The first document of each range is
    also dealt, as the one `ahead`, to the range before it, and the very first to the last,
    so that a task needs no other. Null ids come last, equal ids in the order of the hashes
    `h` of their texts.
    """
    spark = docs.sparkSession
    cuts = _ranges(docs)
    keyed = docs.select(
        _range_of(F.col("doc_id"), cuts).alias("range"),
        "doc_id",
        F.xxhash64("text").alias("h"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h")
    firsts = sorted(keyed.groupBy("range").agg(F.min(order).alias("first")).collect(), key=lambda row: row.range)
    before = [(row.first.doc_id, row.first.h, firsts[i - 1].range) for i, row in enumerate(firsts)]
    ahead = F.broadcast(spark.createDataFrame(before, "first_id bigint, first_h bigint, before int"))  # a row per range
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))
    copies = F.array_compact(
        F.array(
            F.struct(F.col("range"), F.lit(False).alias("ahead")),
            F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("range"), F.lit(True).alias("ahead"))),
        )
    )
    dealt = keyed.join(ahead, is_first, "left").select(F.explode(copies).alias("c"), "doc_id", "h", "text")
    return (
        dealt.select("c.*", "doc_id", "h", "text")
        .repartition(len(cuts) + 1, "range")
        .sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_last(), "h")
    )


def _row(doc_id: int | None, text: str, code: int, following: str, code_after: int) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed)
    return (
        doc_id, len(text), sha256(changed.encode()).hexdigest(), code, other,
        likeness(code, other), likeness(code, code_after),
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    last = None
    for batch in batches:
        for number, ahead, doc_id, text in zip(*(batch[name].to_pylist() for name in ("range", "ahead", "doc_id", "text"))):
            if last is not None and last[0] == number and last[1]:
                continue  # repeated rows may be ahead more than once
            code = fingerprint(text)
            if last is not None and last[0] == number:
                yield _row(*last[2:], text, code)
            last = (number, ahead, doc_id, text, code)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they and the next document's are."""
    names = ["doc_id", "n_chars", "edited_sha256", "code", "edited_code", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.uint64(), pa.uint64(), pa.float64(), pa.float64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([c.view(pa.int64()) if c.type == pa.uint64() else c for c in columns], names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in _pairs(batches):
            rows.append(row)
            if len(rows) == int(BATCH_ROWS):
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    ddl = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, code bigint, edited_code bigint, "
        "near_edited double, near_next double"
    )
    return beside_next(docs).mapInArrow(compare, ddl)


@dataclass(frozen=True)
class Layout:
    """Tables of fingerprints cut into blocks: one table per choice of the blocks that lead.

    Fingerprints within the radius differ in at most RADIUS blocks, so they agree in all the
    leading blocks of some table. The first such blocks name the one table that counts the pair.
    """

    blocks: int

    @property
    def tables(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.blocks), self.blocks - RADIUS))

    def block(self, number: int) -> tuple[int, int]:
        """Lowest bit and width of a block, the first one highest."""
        high, low = (BITS * (self.blocks - n) // self.blocks for n in (number, number + 1))
        return low, high - low

    def places(self, table: int) -> dict[int, int]:
        """Lowest bit of each block once the table's leading blocks stand in front."""
        lead = self.tables[table]
        at, found = BITS, {}
        for number in [*lead, *(n for n in range(self.blocks) if n not in lead)]:
            at -= self.block(number)[1]
            found[number] = at
        return found

    def key_bits(self, table: int) -> int:
        return sum(self.block(number)[1] for number in self.tables[table])

    def permuted(self, code: Column, table: int) -> Column:
        out = F.lit(0).cast("long")
        for number, place in self.places(table).items():
            low, width = self.block(number)
            part = F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << width) - 1))
            out = out.bitwiseOR(F.shiftleft(part, place))
        return out

    def differing(self, table: int) -> list[tuple[np.uint64, np.uint64]]:
        """Shift and mask of the permuted blocks in which a pair must differ, or an earlier table counts it."""
        lead, places = self.tables[table], self.places(table)
        others = [n for n in range(max(lead)) if n not in lead]
        return [(np.uint64(places[n]), np.uint64((1 << self.block(n)[1]) - 1)) for n in others]


def layout_for(codes: int) -> Layout:
    return Layout(next(blocks for most, blocks in BLOCKS if codes <= most))


def block_tables(codes: DataFrame, layout: Layout) -> DataFrame:
    """One entry per fingerprint and table, permuted so that the table's blocks lead; `key` are the first bits of that."""
    entries = [
        F.struct(F.lit(t).alias("table"), layout.permuted(F.col("code"), t).alias("permuted"))
        for t in range(len(layout.tables))
    ]
    return (
        codes.withColumn("e", F.explode(F.array(*entries)))
        .select("*", "e.*")
        .drop("e")
        .withColumn("key", F.shiftrightunsigned("permuted", BITS - DEALT))
    )


def _matches(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Per searched fingerprint: the documents whose fingerprints lie within the radius, among those under its keys."""
    group, queries, permuted = None, None, None
    for batch in batches:
        keys = [batch[name].to_numpy() for name in ("table", "key", "part")]
        kind = batch["target"].to_numpy(zero_copy_only=False)
        codes, places = batch["code"].to_numpy(), batch["permuted"].to_numpy().view(np.uint64)
        weight = batch["n"].to_numpy()
        changes = np.any([k[1:] != k[:-1] for k in keys], axis=0) if len(kind) else np.zeros(0, bool)
        starts = np.flatnonzero(np.append(True, changes)) if len(kind) else []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in zip(starts, np.append(starts[1:], len(kind))):
            here = tuple(k[a] for k in keys)
            cut = a + int(np.searchsorted(kind[a:b], True))
            if here != group:
                group, queries, permuted = here, codes[a:cut], places[a:cut]
            elif cut > a:
                queries, permuted = np.append(queries, codes[a:cut]), np.append(permuted, places[a:cut])
            if len(queries) and cut < b:
                found.append((queries, _counts(permuted, places[cut:b], weight[cut:b], layout, int(here[0]))))
        if found:
            all_queries, counts = (np.concatenate(column) for column in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(all_queries), pa.array(counts)], ["code", "n_near"])


def _counts(queries: np.ndarray, targets: np.ndarray, weight: np.ndarray, layout: Layout, table: int) -> np.ndarray:
    """Documents near each query. Targets are sorted, so those under a query's key are found by binary search."""
    rest = np.uint64(BITS - layout.key_bits(table))
    lowest = queries >> rest << rest
    begin = np.searchsorted(targets, lowest, side="left")
    sizes = np.searchsorted(targets, lowest | ((np.uint64(1) << rest) - np.uint64(1)), side="right") - begin
    counts = np.zeros(len(queries), np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(queries):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + PAIRS, side="right")))
        n = sizes[at:stop]
        query = np.repeat(np.arange(at, stop), n)
        target = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[at:stop], n)
        apart = queries[query] ^ targets[target]
        near = np.bitwise_count(apart) <= RADIUS
        for shift, mask in layout.differing(table):
            near &= (apart >> shift & mask) != 0
        np.add.at(counts, query[near], weight[target[near]])
        at = stop
    return counts


def near_counts(codes: DataFrame, queries: DataFrame) -> DataFrame:
    """`(code, n_near)`: for each fingerprint of `queries`, the documents within the radius, itself included.

    `codes` holds distinct fingerprints and their numbers of documents `n`. Tables and the
    length of their keys follow the number of fingerprints. First bits that very many share
    are dealt out in parts, to each of which the queries with these bits go.
    """
    layout = layout_for(codes.count())
    targets = block_tables(codes, layout)
    sizes = targets.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > PART)
    parts = sizes.select("table", "key", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    dealt = targets.join(parts, ["table", "key"], "left").withColumn(
        "part", F.pmod(F.xxhash64("code"), F.coalesce("parts", F.lit(1))).cast("int")
    )
    asked = (
        block_tables(queries.select("code").distinct().withColumn("n", F.lit(0).cast("long")), layout)
        .join(parts, ["table", "key"], "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    )
    columns = ["table", "key", "part", "code", "permuted", "n"]
    both = asked.select(*columns, F.lit(False).alias("target")).unionByName(
        dealt.select(*columns, F.lit(True).alias("target"))
    )
    placed = both.repartition("table", "key", "part").sortWithinPartitions("table", "key", "part", "target", "permuted")
    # Entries of one key agree in their sign, so they are sorted as unsigned numbers too.
    found = placed.mapInArrow(lambda batches: _matches(batches, layout), "code bigint, n_near bigint")
    return found.groupBy("code").agg(F.sum("n_near").alias("n_near"))


#: Documents whose neighbours are searched: those with ids divisible by this.
SEARCHED = 50


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses, per row.

    `n_near` is the number of other documents within RADIUS bits, for ids divisible by
    SEARCHED (null for others). A null text is an empty one; its fingerprint is zero. A null
    id comes last in the order of ids and isn't searched. Rows with equal ids follow each
    other; the only document is its own next. An empty table gives no rows; other columns
    are ignored.
    """
    rows = stored(compared_with_next(docs.select("doc_id", "text")), "fingerprints")
    codes = stored(rows.groupBy("code").agg(F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    asked = F.col("doc_id") % SEARCHED == 0
    near = near_counts(codes, rows.filter(asked))
    return rows.join(near, "code", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"),
        F.lpad(F.lower(F.hex("edited_code")), 16, "0").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(asked, F.col("n_near") - 1).alias("n_near"),
    )
