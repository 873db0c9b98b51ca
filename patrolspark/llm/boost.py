"""Small gradient boosted trees for the logistic loss (second-order, binned)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boost:
    trees: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 16
    ridge: float = 1.0
    cuts: list[np.ndarray] = field(default_factory=list)
    model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boost:
        q = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, f], q, method="lower")) for f in range(x.shape[1])]
        binned = self._binned(x)
        score = np.zeros(len(x))
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            tree = self._tree(binned, p - y, p * (1 - p))
            self.model.append(tree)
            score += self._leaf(tree, binned)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        score = sum((self._leaf(t, binned) for t in self.model), np.zeros(len(x)))
        return 1 / (1 + np.exp(-score))

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)

    def _tree(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        """Feature and bin of every inner node of a full tree, and the leaves' steps."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, self.bins, dtype=np.int64)
        node = np.zeros(len(b), dtype=np.int64)
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.zeros(count)
            for f in range(b.shape[1]):
                cell = (node - first) * (self.bins + 1) + b[:, f]
                size = count * (self.bins + 1)
                gs = np.bincount(cell, g, size).reshape(count, -1).cumsum(axis=1)
                hs = np.bincount(cell, h, size).reshape(count, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = (gs ** 2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge)
                        - gt ** 2 / (ht + self.ridge))
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                better = top > best + 1e-9
                best[better] = top[better]
                feature[first:first + count][better] = f
                cut[first:first + count][better] = at[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - inner
        total = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        return feature, cut, -self.rate * total[0] / (total[1] + self.ridge)

    def _leaf(self, tree, b: np.ndarray) -> np.ndarray:
        feature, cut, step = tree
        node = np.zeros(len(b), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return step[node - len(feature)]
