"""A small gradient-boosted tree classifier on binned features (numpy, logistic loss)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Complete binary trees of one depth: split features and limits by level order, values of the leaves."""

    depth: int = 3
    rounds: int = 40
    rate: float = 0.3
    bins: int = 32
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, k = x.shape
        edges = [self._edges(x[:, j]) for j in range(k)]
        code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start, self.trees = float(np.log(share / (1 - share))), []
        z = np.full(n, self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            grad, hess = y - p, p * (1 - p)
            feature, limit = np.zeros(2 ** self.depth - 1, int), np.full(2 ** self.depth - 1, np.inf)
            node = np.zeros(n, int)
            for level in range(self.depth):
                first = 2 ** level - 1
                for v in range(first, 2 * first + 1):
                    rows = np.flatnonzero(node == v)
                    best = 1e-6
                    for j in range(k if len(rows) else 0):
                        g = np.bincount(code[rows, j], grad[rows], self.bins + 1).cumsum()
                        h = np.bincount(code[rows, j], hess[rows], self.bins + 1).cumsum()
                        gain = g ** 2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
                        b = int(gain[:len(edges[j])].argmax()) if len(edges[j]) else -1
                        if b >= 0 and gain[b] > best:
                            best, feature[v], limit[v] = gain[b], j, edges[j][b]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
            leaf = node - (2 ** self.depth - 1)
            g = np.bincount(leaf, grad, 2 ** self.depth)
            h = np.bincount(leaf, hess, 2 ** self.depth)
            value = self.rate * g / (h + 1)
            self.trees.append((feature, limit, value))
            z += value[leaf]
        return self

    def _edges(self, v: np.ndarray) -> np.ndarray:
        """Limits between bins: every value's own if there are few values, else quantiles."""
        own = np.unique(v)
        if len(own) > self.bins:
            return np.unique(np.quantile(v, np.linspace(0, 1, self.bins + 1)[1:-1]))
        return own[:-1]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of class 1."""
        z = np.full(len(x), self.start)
        at = np.arange(len(x))
        for feature, limit, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[at, feature[node]] > limit[node])
            z += value[node - (2 ** self.depth - 1)]
        return 1 / (1 + np.exp(-z))
