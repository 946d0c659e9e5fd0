"""A hierarchical index over fingerprints in Gray order, for one group at a time of a sorted array.

Neighbours in Gray order share long bit patterns. Every node stands for up to `FAN` nodes
of the level below it and keeps the bits that all fingerprints under it share (a pattern
and its mask). Two nodes are compared from the roots down: each level counts only the
bits that are newly shared below, the differences accumulate, and a pair of nodes whose
differences exceed the radius is dropped with everything under it. A pair that can't
exceed it any more is linked whole.
"""

from __future__ import annotations

import numpy as np

FAN = 8
PAIRS = 1 << 20
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _spans(counts: np.ndarray) -> np.ndarray:
    """0 .. count-1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Forest:
    """Components under construction: every item points at the smallest item known to be linked with it."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                nearer = self.root[self.root]
                if np.array_equal(nearer, self.root):
                    break
                self.root = nearer


class GrayIndex:
    """Index of fingerprints sorted by (group, Gray rank); `starts` are the first places of the groups."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        self.codes = codes
        sizes = np.diff(np.append(starts, len(codes)))
        size = len(codes)
        # Per level: pattern, mask, first child, number of children, first and end of the leaves below.
        leaf = np.arange(size)
        self.levels = [(codes, np.full(size, ALL), leaf, np.ones(size, np.int64), leaf, leaf + 1)]
        while len(sizes) and sizes.max() > 1:
            pattern, mask, _, _, lo, hi = self.levels[-1]
            parents = -(-sizes // FAN)
            nth = _spans(parents)
            first = np.repeat(np.cumsum(sizes) - sizes, parents) + nth * FAN
            count = np.minimum(np.repeat(sizes, parents) - nth * FAN, FAN)
            # A bit is shared if it is known in all children and equal in them.
            known = np.bitwise_and.reduceat(mask, first)
            ones = np.bitwise_and.reduceat(pattern | ~mask, first)
            zeros = np.bitwise_and.reduceat(~pattern | ~mask, first)
            shared = known & (ones | zeros)
            self.levels.append((ones & shared, shared, first, count, lo[first], hi[first + count - 1]))
            sizes = parents

    def components(self, radius: int) -> np.ndarray:
        """For every fingerprint the place of the first one of its group that it is linked with, over any number of links."""
        forest = Forest(len(self.codes))
        if not len(self.codes):
            return forest.root
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        work = [(top, roots, roots, np.zeros(len(roots), np.uint8), np.zeros(len(roots), np.uint64))]
        while work:
            level, a, b, differences, compared = work.pop()
            if len(a) > PAIRS:
                for cut in (slice(PAIRS, None), slice(0, PAIRS)):
                    work.append((level, a[cut], b[cut], differences[cut], compared[cut]))
                continue
            pattern, mask, _, _, lo, hi = self.levels[level]
            both = mask[a] & mask[b]
            differences = differences + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~compared)
            near = differences <= radius
            if level == 0:
                forest.link(a[near], b[near])
                continue
            near &= ~self._joined(level, forest, a, b)
            a, b, differences, both = a[near], b[near], differences[near], both[near]
            whole = differences + np.bitwise_count(~both) <= radius
            for x in (a[whole], b[whole]):
                counts = hi[x] - lo[x]
                forest.link(np.repeat(lo[a[whole]], counts), np.repeat(lo[x], counts) + _spans(counts))
            part = ~whole
            if part.any():
                work.append((level - 1, *self._children(level, a[part], b[part], differences[part], both[part])))
        return forest.root

    def _joined(self, level: int, forest: Forest, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of nodes under which everything is in one component already."""
        *_, lo, hi = self.levels[level]
        # Nodes of a level cover the leaves without gaps.
        least, most = np.minimum.reduceat(forest.root, lo), np.maximum.reduceat(forest.root, lo)
        alike = least == most
        return alike[a] & alike[b] & (least[a] == least[b])

    def _children(self, level, a, b, differences, both):
        _, _, first, count, _, _ = self.levels[level]
        na, nb = count[a], count[b]
        pairs = na * nb
        row = np.repeat(np.arange(len(a)), pairs)
        nth = _spans(pairs)
        x = first[a][row] + nth // nb[row]
        y = first[b][row] + nth % nb[row]
        keep = (x < y) | ((x == y) & (level > 1))
        row = row[keep]
        return x[keep], y[keep], differences[row], both[row]
