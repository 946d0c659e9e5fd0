"""Byte-level BPE with a rank file: encoding by two tiers of lookup, and decoding.

A pre-token that is a token itself is found by a minimal perfect hash of the vocabulary.
Any other is split into bytes that form a linked list, whose neighbours are merged in the
order of a heap of ranks.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import sha256
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import empty_if_null
from meterflow.llm.memo import Memo
from meterflow.llm.perfect_hash import PerfectHash

#: Pre-tokens whose ids a Python worker remembers, twice at most (about 200 bytes each), if they are not longer.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64
#: Texts are encoded together until they have so many characters.
TOGETHER = 500_000
DEAD = -1
PLACE = 0xFFFFFFFF


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (`base64 rank` lines) in the order of their ids."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"{path}: ranks are not 0 to n - 1")
    return [token for _, token in ranked]


def _as_ranges(pattern: str) -> str:
    """The characters up to U+FFFF that a pattern matches, as the inside of a character class."""
    matching = np.zeros(0x10001, np.int8)
    compiled = regex.compile(pattern)
    for code in range(0x10000):
        if not 0xD800 <= code < 0xE000:
            matching[code] = compiled.match(chr(code)) is not None
    edges = np.flatnonzero(np.diff(matching, prepend=0))
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in edges.reshape(-1, 2).tolist())


def plain_pattern(pattern: str) -> str:
    """The same pattern for the faster `re`, right for texts without characters beyond U+FFFF."""
    inside = {kind: _as_ranges(kind) for kind in (r"\p{L}", r"\p{N}", r"\s")}
    inside[r"\S"] = None
    out, in_class = [], False
    for part in re.findall(r"\\p\{\w\}|\\.|.", pattern, re.S):
        in_class = part == "[" or in_class and part != "]"
        if part == r"\S":
            out.append(f"[^{inside[chr(92) + 's']}]")
        elif part in inside:
            out.append(inside[part] if in_class else f"[{inside[part]}]")
        else:
            out.append(part)
    return "".join(out)


@dataclass
class Bpe:
    """A vocabulary and its splitting pattern; what it derives from them stays in the process that uses it."""

    tokens: list[bytes]
    pattern: str
    plain: str = field(default="")

    def __post_init__(self):
        self.plain = self.plain or plain_pattern(self.pattern)

    def __getstate__(self):
        return {"tokens": self.tokens, "pattern": self.pattern, "plain": self.plain}

    @cached_property
    def ids(self) -> dict[bytes, int]:
        return {token: i for i, token in enumerate(self.tokens)}

    @cached_property
    def whole(self) -> tuple[PerfectHash, list[int]]:
        """The perfect hash, and the id at each of its places."""
        table = PerfectHash(self.tokens)
        at = np.empty(len(self.tokens), np.int64)
        at[table.places(self.tokens)] = np.arange(len(self.tokens))
        return table, at.tolist()

    @cached_property
    def _plain(self):
        return re.compile(self.plain)

    @cached_property
    def _full(self):
        return regex.compile(self.pattern)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The id that a pair of ids merges into."""
        made, ids = {}, self.ids
        for token, i in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    made[left << 32 | right] = i
        return made

    @cached_property
    def bytes_(self) -> list[int]:
        return [self.ids[bytes([value])] for value in range(256)]

    @cached_property
    def _memo(self) -> Memo:
        return Memo(self._encode_new, REMEMBERED, LONGEST_REMEMBERED)

    def split(self, text: str) -> list[str]:
        narrow = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
        return (self._plain if narrow else self._full).findall(text)

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        """The ids of pre-tokens, as little-endian 32-bit integers."""
        raw = [piece.encode() for piece in pieces]
        table, at = self.whole
        out = []
        for piece, place in zip(raw, table.places(raw).tolist()):
            whole = place >= 0 and self.tokens[at[place]] == piece
            ids = [at[place]] if whole else self.merged(piece)
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    def merged(self, piece: bytes) -> list[int]:
        """Merge the bytes of a piece: always the neighbours whose union has the lowest rank, leftmost first."""
        get, size = self.pairs.get, len(piece)
        ids = [self.bytes_[value] for value in piece]
        after, before = list(range(1, size + 2)), list(range(-1, size))
        union = [get(x << 32 | y, DEAD) for x, y in zip(ids, ids[1:])]
        union.append(DEAD)
        heap = [rank << 32 | i for i, rank in enumerate(union) if rank != DEAD]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, rank = top & PLACE, top >> 32
            if union[i] != rank:  # merged away or with another neighbour since
                continue
            j = after[i]
            k = after[j]
            ids[i], ids[j], union[j], after[i] = rank, DEAD, DEAD, k
            if k < size:
                before[k] = i
                union[i] = other = get(rank << 32 | ids[k], DEAD)
                if other != DEAD:
                    heappush(heap, other << 32 | i)
            else:
                union[i] = DEAD
            if i:
                h = before[i]
                union[h] = other = get(ids[h] << 32 | rank, DEAD)
                if other != DEAD:
                    heappush(heap, other << 32 | h)
        return [i for i in ids if i != DEAD]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.split(text))
            size += len(text)
            if size >= TOGETHER:
                yield from self._encode_split(held)
                held, size = [], 0
        yield from self._encode_split(held)

    def _encode_split(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        known = self._memo.known([piece for pieces in texts for piece in pieces]).__getitem__
        for pieces in texts:
            yield np.frombuffer(b"".join(map(known, pieces)), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


ENCODED = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string, ids: array<int>>"


def load(path: str, pattern: str) -> Bpe:
    return Bpe(read_ranks(path), pattern)


def encoded(spark: SparkSession, text: Column, bpe: Bpe, with_ids: bool = True) -> Column:
    """The ids of a text, their digest and the digest of what they decode to, as a struct."""
    shared = spark.sparkContext.broadcast(bpe)
    kind = pa.struct(
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))]
    )

    @F.arrow_udf(ENCODED)  # the broadcast keeps one copy of the tables per worker process
    def encode(texts: pa.Array) -> pa.Array:
        rows = []
        for ids in shared.value.encode(empty_if_null(texts)):
            back = sha256(shared.value.decode(ids)).hexdigest()
            rows.append(
                {
                    "n_tokens": len(ids),
                    "ids_sha256": sha256(ids).hexdigest(),
                    "decoded_sha256": back,
                    "ids": ids.astype(np.int32) if with_ids else None,
                }
            )
        return pa.array(rows, kind)

    return encode(text)


def encoded_documents(docs: DataFrame, bpe: Bpe, with_ids: bool = True) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256` and `ids` (32-bit) of every row.

    A null text is an empty one: no ids, and digests of nothing. Every row is encoded by
    itself, so null and repeated ids don't matter; other columns are ignored.
    """
    spark = docs.sparkSession
    coded = docs.select("doc_id", encoded(spark, F.col("text"), bpe, with_ids).alias("coded"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    return coded.select("doc_id", *[f"coded.{name}" for name in names])
