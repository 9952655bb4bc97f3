"""Gradient-boosted regression trees for two classes: histogram splits, logistic loss, numpy only."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """``rounds`` trees of ``depth`` levels on features cut into at most ``bins`` quantile bins; constant when one class is absent."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 5, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "BoostedTrees":
        y = np.asarray(y, float)
        weight = np.ones(len(y)) if weight is None else weight
        mean = np.clip(np.average(y, weights=weight) if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.bias, self.trees = float(np.log(mean / (1 - mean))), []
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T] if len(y) else []
        if len(y) == 0 or y.min() == y.max():
            return self
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)], 1)
        margin = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, weight * (y - p), weight * p * (1 - p))
            self.trees.append(tree)
            margin += tree[2][self._leaf(tree, binned)]
        return self

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arrays over the nodes of a complete tree: split feature (-1: none), split bin, leaf value."""
        n = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(n, -1), np.zeros(n, int), np.zeros(n)
        at = np.zeros(len(g), int)
        for node in range(n):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = self.rate * gs / (hs + self.ridge)
            if node >= n // 2 or len(rows) < 2 * self.least:
                continue
            best = (1e-6, -1, 0)
            for f, edges in enumerate(self.edges):
                if not len(edges):
                    continue
                b = binned[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(b, w, len(edges) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                gain = gl**2 / (hl + self.ridge) + (gs - gl) ** 2 / (hs - hl + self.ridge) - gs**2 / (hs + self.ridge)
                gain[(nl < self.least) | (len(rows) - nl < self.least)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k)
            if best[1] >= 0:
                feature[node], cut[node] = best[1], best[2]
                at[rows] = 2 * node + 1 + (binned[rows, best[1]] > best[2])
        return feature, cut, value

    def _leaf(self, tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, _ = tree
        at, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(self.depth):
            f = feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (binned[rows, np.maximum(f, 0)] > cut[at]), at)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        margin = np.full(len(x), self.bias)
        if self.trees and len(x):
            binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)], 1)
            for tree in self.trees:
                margin += tree[2][self._leaf(tree, binned)]
        return 1 / (1 + np.exp(-margin))
