"""Gradient-boosted trees for small tables of features: logistic loss, shallow trees on binned features."""

from __future__ import annotations

import numpy as np

ROUNDS, DEPTH, RATE, BINS, MIN_ROWS = 40, 3, 0.2, 32, 4


class Boosted:
    """sigmoid(base + sum of trees). A tree is arrays by node number: the children of node i are
    2 i + 1 (at most the edge) and 2 i + 2."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
        binned = self._bin(x)
        margin = np.full(len(y), self.base)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(tree, binned)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    @staticmethod
    def _grow(binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes, int), np.zeros(nodes)
        place = np.zeros(len(g), int)
        for node in range(nodes):
            mine = np.flatnonzero(place == node)
            total_g, total_h = g[mine].sum(), h[mine].sum()
            value[node] = RATE * total_g / (total_h + 1.0)
            if node >= nodes // 2 or len(mine) < 2 * MIN_ROWS:
                continue
            best = 1e-6
            for j in range(binned.shape[1]):
                b = binned[mine, j]
                n = np.cumsum(np.bincount(b, minlength=BINS))
                left_g, left_h = np.cumsum(np.bincount(b, g[mine], BINS)), np.cumsum(np.bincount(b, h[mine], BINS))
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                gain[(n < MIN_ROWS) | (len(mine) - n < MIN_ROWS)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, feature[node], cut[node] = gain[k], j, k
            if feature[node] >= 0:
                place[mine] = 2 * node + 1 + (binned[mine, feature[node]] > cut[node])
        return feature, cut, value

    @staticmethod
    def _leaf(tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(binned), int)
        for _ in range(DEPTH):
            inner = feature[node] >= 0
            at = node[inner]
            node[inner] = 2 * at + 1 + (binned[inner, feature[at]] > cut[at])
        return value[node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        binned = self._bin(x)
        return 1 / (1 + np.exp(-(self.base + sum(self._leaf(t, binned) for t in self.trees))))
