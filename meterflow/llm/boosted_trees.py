"""Gradient-boosted trees over histograms, flattened into arrays.

All trees are complete to a fixed depth, so a row's way down is the same arithmetic in
every tree, and rows and trees are walked together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosting:
    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    shrink: float = 2.0
    least: float = 5.0  # least sum of second derivatives on either side of a split


@dataclass
class Trees:
    base: float
    depth: int
    feature: np.ndarray  # [tree, inner node]; node k has the children 2k + 1 and 2k + 2
    threshold: np.ndarray
    leaf: np.ndarray  # [tree, leaf]

    def margins(self, rows: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(rows), len(trees)), np.int64)
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            right = rows[row, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[trees, node - (2**self.depth - 1)].sum(axis=1)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(rows)))


def edges_of(column: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds that cut a column into bins of about equal numbers of rows."""
    return np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower"))


def train(rows: np.ndarray, labels: np.ndarray, how: Boosting = Boosting()) -> Trees:
    """Fit to 0/1 labels by logistic loss."""
    n, width = rows.shape
    edges = [edges_of(rows[:, f], how.bins) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner, leaves = 2**how.depth - 1, 2**how.depth
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    features = np.zeros((how.trees, inner), np.int64)
    thresholds = np.full((how.trees, inner), np.inf, np.float32)
    values = np.zeros((how.trees, leaves))
    margin = np.full(n, base)
    columns = binned + np.arange(width) * how.bins
    for t in range(how.trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        slope, curve = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(how.depth):
            nodes = 2**level
            place = (node[:, None] * (width * how.bins) + columns).reshape(-1)
            shape = (nodes, width, how.bins)
            g = np.bincount(place, np.repeat(slope, width), nodes * width * how.bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(place, np.repeat(curve, width), nodes * width * how.bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + how.shrink) + (g_all - g) ** 2 / (h_all - h + how.shrink) - g_all**2 / (h_all + how.shrink)
            gain[(h < how.least) | (h_all - h < how.least)] = 0.0
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0.0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            f, b = best // how.bins, best % how.bins
            split = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            at = nodes - 1 + np.arange(nodes)
            features[t, at] = f
            thresholds[t, at] = [edges[x][y] if s else np.inf for x, y, s in zip(f, b, split)]
            node = 2 * node + (split[node] & (binned[np.arange(n), f[node]] > b[node]))
        g = np.bincount(node, slope, leaves)
        h = np.bincount(node, curve, leaves)
        values[t] = how.rate * g / (h + how.shrink)
        margin += values[t, node]
    return Trees(base, how.depth, features, thresholds, values)
