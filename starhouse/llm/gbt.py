"""Gradient-boosted regression trees for binary labels (logistic loss) in numpy, on binned features."""

from __future__ import annotations

import numpy as np


class GBT:
    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 24, leaf: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.leaf = rounds, depth, rate, bins, leaf
        self.bias, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> GBT:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) if len(c) else c for c in x.T]
        b = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.bias = float(np.log(share / (1 - share)))
        f = np.full(len(y), self.bias)
        for _ in range(self.rounds if len(y) else 0):
            p = 1 / (1 + np.exp(-f))
            tree: list = []
            f += self.rate * self._grow(b, y - p, p * (1 - p), np.arange(len(y)), self.depth, tree)
            self.trees.append(tree)
        return self

    def _binned(self, x):
        return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T, strict=True)], axis=1)

    def _grow(self, b, g, h, rows, depth, tree):
        """Append a node for ``rows`` and return the values of all rows (0 outside). A node is (feature, bin,
        left, right) or (None, value)."""
        at = len(tree)
        tree.append(None)
        out = np.zeros(len(g))
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        if depth and len(rows) > 8:
            for j in range(b.shape[1]):
                k = len(self.cuts[j]) + 1
                if k < 2:
                    continue
                cg = np.bincount(b[rows, j], weights=g[rows], minlength=k).cumsum()[:-1]
                ch = np.bincount(b[rows, j], weights=h[rows], minlength=k).cumsum()[:-1]
                gain = cg**2 / (ch + self.leaf) + (gs - cg)**2 / (hs - ch + self.leaf) - gs**2 / (hs + self.leaf)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], j, i)
        if best[1] is None:
            value = gs / (hs + self.leaf)
            tree[at] = (None, value)
            out[rows] = value
            return out
        left = b[rows, best[1]] <= best[2]
        lo = len(tree)
        out += self._grow(b, g, h, rows[left], depth - 1, tree)
        hi = len(tree)
        out += self._grow(b, g, h, rows[~left], depth - 1, tree)
        tree[at] = (best[1], best[2], lo, hi)
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        b = self._binned(x)
        f = np.full(len(x), self.bias)
        for tree in self.trees:
            stack = [(0, np.arange(len(x)))]
            while stack:
                at, rows = stack.pop()
                node = tree[at]
                if node[0] is None:
                    f[rows] += self.rate * node[1]
                    continue
                left = b[rows, node[0]] <= node[1]
                stack += [(node[2], rows[left]), (node[3], rows[~left])]
        return f
