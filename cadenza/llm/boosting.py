"""Gradient-boosted trees for two classes on numeric features, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting with histogram trees of fixed depth."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32,
                 least: float = 4.0, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.least, self.ridge = least, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c) for e, c in zip(self.edges, x.T, strict=True)], 1)
        share = np.clip((weight * y).sum() / weight.sum(), 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        z = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            grad, hess = weight * (p - y), np.maximum(weight * p * (1 - p), 1e-6)
            tree, leaf = self._tree(binned, grad, hess)
            self.trees.append(tree)
            z += tree[2][leaf]
        return self

    def _tree(self, binned, grad, hess):
        """(feature, threshold, value) by node of a full tree; a dead end splits nothing."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, self.bins, np.int64)
        at = np.zeros(len(grad), np.int64)
        for level in range(self.depth):
            first, width = (1 << level) - 1, 1 << level
            node = at - first
            best = np.full(width, 1e-6)
            for f in range(binned.shape[1]):
                key = node * self.bins + binned[:, f]
                g = np.bincount(key, grad, width * self.bins).reshape(width, -1).cumsum(1)
                h = np.bincount(key, hess, width * self.bins).reshape(width, -1).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = (g**2 / (h + self.ridge) + (g_all - g)**2 / (h_all - h + self.ridge)
                        - g_all**2 / (h_all + self.ridge))
                gain[(h < self.least / 4) | (h_all - h < self.least / 4)] = 0
                c = gain.argmax(1)
                top = gain[np.arange(width), c]
                better = top > best
                best[better] = top[better]
                feature[first:first + width][better], cut[first:first + width][better] = f, c[better]
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        return (feature, cut, -self.rate * g / (h + self.ridge)), leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, c) for e, c in zip(self.edges, x.T, strict=True)], 1)
        rows = np.arange(len(x))
        z = np.full(len(x), self.base)
        inner = (1 << self.depth) - 1
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            z += value[at - inner]
        return 1 / (1 + np.exp(-z))
