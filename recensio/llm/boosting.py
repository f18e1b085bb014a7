"""Histogram gradient-boosted trees for two classes in numpy, flattened for traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of shape (trees, nodes): node k's children are 2k+1 and 2k+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for every row; all trees go down one level at a time."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        margin = self.start + self.value[trees, node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def constant(share: float) -> Forest:
    """A forest without splits."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Forest(np.zeros((1, 1), int), np.full((1, 1), np.inf), np.zeros((1, 1)), float(np.log(share / (1 - share))), 0)


def train(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 10, ridge: float = 1.0
) -> Forest:
    """Boost ``trees`` trees of ``depth`` levels on the logistic loss; splits are bin edges.

    Too few rows, or one class only, give a forest without splits.
    """
    share = float(np.mean(y)) if len(y) else 0.5
    if len(y) < 2 * least or share in (0.0, 1.0):
        return constant(share)
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner, nodes = 2**depth - 1, 2 ** (depth + 1) - 1
    feature, threshold, value = np.zeros((trees, nodes), int), np.full((trees, nodes), np.inf), np.zeros((trees, nodes))
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        for level in range(depth):
            low, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            cut = np.full(width, bins)
            at = np.zeros(width, int)
            place = (node - low) * bins
            for f in range(x.shape[1]):
                key = place + binned[:, f]
                g, h, n = (
                    np.cumsum(np.bincount(key, weights=w, minlength=width * bins).reshape(width, bins), axis=1)
                    for w in (gradient, hessian, None)
                )
                total = lambda s, last: s * s / (last + ridge)
                gain = total(g, h) + total(g[:, -1:] - g, h[:, -1:] - h) - total(g[:, -1:], h[:, -1:])
                gain[(n < least) | (n[:, -1:] - n < least)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better], at[better], cut[better] = top[better], f, k[better]
            for k in range(width):
                if cut[k] < len(edges[at[k]]):
                    feature[t, low + k], threshold[t, low + k] = at[k], edges[at[k]][cut[k]]
            right = x[np.arange(len(y)), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        g, h = (np.bincount(node - inner, weights=w, minlength=inner + 1) for w in (gradient, hessian))
        value[t, inner:] = rate * g / (h + ridge)
        margin += value[t, node]
    return Forest(feature, threshold, value, start, depth)
