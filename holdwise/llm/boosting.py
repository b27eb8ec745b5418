"""Gradient-boosted trees for log-loss in numpy, with a calibration of their scores."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth over binned features: node k of a level goes to 2k or 2k+1 below it."""

    edges: list[np.ndarray]  # per feature: bin borders
    depth: int
    feature: list[np.ndarray] = field(default_factory=list)  # per tree: feature of each inner node
    border: list[np.ndarray] = field(default_factory=list)  # per tree: bins up to this one go left
    value: list[np.ndarray] = field(default_factory=list)  # per tree: leaf values
    start: float = 0.0
    platt: tuple[float, float] = (1.0, 0.0)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], axis=1)

    def leaf(self, bins: np.ndarray, t: int) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        for level in range(self.depth):
            at = node + (1 << level) - 1
            right = bins[np.arange(len(bins)), self.feature[t][at]] > self.border[t][at]
            node = 2 * node + right
        return node

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        return self.start + sum((self.value[t][self.leaf(bins, t)] for t in range(len(self.value))), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * self.raw(x) + b, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    model = Trees(edges, depth)
    binned = model.binned(x)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.start = float(np.log(share / (1 - share)))
    f = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        grad, hess = p - y, p * (1 - p)
        feature, border = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, bins)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            for k in range(1 << level):
                mine = np.flatnonzero(node == k)
                best, at = 1e-9, k + (1 << level) - 1
                if len(mine) > 1:
                    g_all, h_all = grad[mine].sum(), hess[mine].sum()
                    base = g_all**2 / (h_all + ridge)
                    for j in range(x.shape[1]):
                        g = np.cumsum(np.bincount(binned[mine, j], grad[mine], bins))[:-1]
                        h = np.cumsum(np.bincount(binned[mine, j], hess[mine], bins))[:-1]
                        gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - base
                        c = int(np.argmax(gain))
                        if gain[c] > best:
                            best, feature[at], border[at] = gain[c], j, c
            here = node + (1 << level) - 1
            node = 2 * node + (binned[np.arange(len(y)), feature[here]] > border[here])
        g, h = np.bincount(node, grad, 1 << depth), np.bincount(node, hess, 1 << depth)
        model.feature.append(feature)
        model.border.append(border)
        model.value.append(-rate * g / (h + ridge))
        f += model.value[-1][node]
    return model


def fit_logistic(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (z, y), lightly held towards slope 1."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p)
        g = np.array([(z * (p - y)).sum() + (a - 1), (p - y).sum() + 0.1 * b])
        h = np.array([[(z * z * w).sum() + 1, (z * w).sum()], [(z * w).sum(), w.sum() + 0.1]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-6:
            break
    return float(a), float(b)
