"""Gradient-boosted decision trees for small tables: logistic loss, binned features, plain numpy."""

from __future__ import annotations

import numpy as np


class Booster:
    """A classifier of rows of numbers, fitted on a bounded sample on the driver and applied anywhere."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, least: int = 8):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.base, self.forest = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
        p = min(max(y.mean() if len(y) else 0.0, 1e-6), 1 - 1e-6)
        self.base, self.forest = float(np.log(p / (1 - p))), []
        if not len(y) or y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        f = np.full(len(y), self.base)
        for _ in range(self.trees):
            prob = 1 / (1 + np.exp(-f))
            tree = self._grow(codes, edges, y - prob, prob * (1 - prob), np.arange(len(y)), self.depth)
            self.forest.append(tree)
            f += self._apply(tree, x)
        return self

    def _grow(self, codes, edges, g, h, rows, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        leaf = self.rate * total_g / (total_h + 1.0)
        if depth == 0 or len(rows) < 2 * self.least:
            return leaf
        best = (1e-6, None, None)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            c = codes[rows, j]
            gs = np.cumsum(np.bincount(c, g[rows], len(e) + 1))[:-1]
            hs = np.cumsum(np.bincount(c, h[rows], len(e) + 1))[:-1]
            ns = np.cumsum(np.bincount(c, minlength=len(e) + 1))[:-1]
            gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
            gain[(ns < self.least) | (len(rows) - ns < self.least)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        _, j, k = best
        if j is None:
            return leaf
        left = codes[rows, j] <= k
        return j, edges[j][k], self._grow(codes, edges, g, h, rows[left], depth - 1), self._grow(codes, edges, g, h, rows[~left], depth - 1)

    def _apply(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, cut, low, high = tree
        left = x[:, j] <= cut
        out = np.empty(len(x))
        out[left], out[~left] = self._apply(low, x[left]), self._apply(high, x[~left])
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of each row."""
        x = np.asarray(x, dtype=float)
        f = np.full(len(x), self.base)
        for t in self.forest:
            f += self._apply(t, x)
        return 1 / (1 + np.exp(-f))
