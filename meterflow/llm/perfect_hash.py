"""A minimal perfect hash of a fixed set of byte strings, looked up for whole arrays at once."""

from __future__ import annotations

import numpy as np
import xxhash

WORD = np.uint64(63)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * (SPREAD + np.uint64(2 * level))
    return (mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)


class PerfectHash:
    """Levels of bit arrays: a key owns the first slot that no other key left over at that level wants.

    The number of bits set before a key's own is its place, so n keys have the places 0 to
    n - 1. A string that isn't a key may get a place too: the caller compares it with the
    key there.
    """

    def __init__(self, keys: list[bytes]):
        left = self.hashes(keys)
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        before = 0
        while len(left):
            size = max(64, 2 * len(left))
            slots = _slots(left, len(self.levels), size)
            counts = np.bincount(slots, minlength=-(-size // 64) * 64)
            bits = np.packbits(counts == 1, bitorder="little").view("<u8")
            ones = np.bitwise_count(bits).astype(np.int64)
            self.levels.append((size, bits, before + np.cumsum(ones) - ones))
            before += int(ones.sum())
            left = left[counts[slots] != 1]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))

    def places(self, keys: list[bytes]) -> np.ndarray:
        """The place of each string, or -1 for some of those that aren't keys."""
        hashes = self.hashes(keys)
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, bits, before) in enumerate(self.levels):
            slots = _slots(hashes[open_], level, size)
            word, bit = slots >> np.uint64(6), slots & WORD
            here = (bits[word] >> bit & np.uint64(1)).astype(bool)
            lower = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = before[word] + np.bitwise_count(lower)
            found[open_[here]] = rank[here]
            open_ = open_[~here]
            if not len(open_):
                break
        return found
