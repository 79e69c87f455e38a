"""Gradient-boosted regression trees for a yes-or-no target, on bounded training data.

Trees are kept as arrays, so that a task scores many rows by a few lookups.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 32


class Trees(NamedTuple):
    """Complete trees of equal depth: per inner node a feature and a limit, per leaf a value."""

    start: float
    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        """Chance of yes for each row of ``x``."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for features, limits, leaves in zip(self.features, self.limits, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, features[node]] > limits[node])
            total += leaves[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, least: float = 5.0) -> Trees:
    """Newton boosting of the logistic loss over ``BINS`` quantile bins a feature."""
    count, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    total = np.full(count, start)
    inner, ends = 2**depth - 1, 2**depth
    all_features, all_limits, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        features, limits, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, BINS)
        node = np.zeros(count, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = node - first
            best = np.full(nodes, 1e-6)
            whole_g, whole_h = np.bincount(place, g, nodes), np.bincount(place, h, nodes)
            for j in range(width):
                if not len(edges[j]):
                    continue
                cell = place * BINS + binned[:, j]
                left_g = np.bincount(cell, g, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                left_h = np.bincount(cell, h, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                right_g, right_h = whole_g[:, None] - left_g, whole_h[:, None] - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - (whole_g**2 / (whole_h + 1))[:, None]
                gain[(left_h < least) | (right_h < least)] = 0
                gain = gain[:, : len(edges[j])]
                cut = gain.argmax(1)
                better = gain[np.arange(nodes), cut] > best
                best = np.where(better, gain[np.arange(nodes), cut], best)
                at = first + np.flatnonzero(better)
                features[at], cuts[at], limits[at] = j, cut[better], edges[j][cut[better]]
            node = 2 * node + 1 + (binned[np.arange(count), features[node]] > cuts[node])
        leaf = node - inner
        leaves = rate * np.bincount(leaf, g, ends) / (np.bincount(leaf, h, ends) + 1)
        total += leaves[leaf]
        all_features.append(features)
        all_limits.append(limits)
        all_leaves.append(leaves)
    return Trees(start, np.array(all_features), np.array(all_limits), np.array(all_leaves))
