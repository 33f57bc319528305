"""Gradient-boosted depth-limited trees for a yes/no label, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees as arrays: node i of a tree splits on feature[i] <= cut[i], children 2i+1 and 2i+2."""

    def __init__(self, base: float, depth: int, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray,
                 slope: float = 1.0, shift: float = 0.0):
        self.base, self.depth, self.feature, self.cut, self.leaf = base, depth, feature, cut, leaf
        self.slope, self.shift = slope, shift

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - len(f)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated: a logistic curve of the trees' sum, fitted on rows held aside."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Second-order boosting of the log loss; split points are the features' quantiles."""
    n, m = x.shape
    inner = (1 << depth) - 1
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)], 1)
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(n, base)
    features, edges, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best, where = 1e-9, None
            if len(rows):
                g, h = grad[rows].sum(), hess[rows].sum()
                for j in range(m):
                    k = len(cuts[j]) + 1
                    gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], k))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], k))[:-1]
                    gain = gl**2 / (hl + ridge) + (g - gl)**2 / (h - hl + ridge) - g**2 / (h + ridge)
                    if len(gain) and gain.max() > best:
                        best, where = gain.max(), (j, int(gain.argmax()))
            if where:
                feature[node], cut[node] = where[0], cuts[where[0]][where[1]]
            at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        g = np.bincount(at - inner, grad, inner + 1)
        h = np.bincount(at - inner, hess, inner + 1)
        value = rate * g / (h + ridge)
        score += value[at - inner]
        features.append(feature)
        edges.append(cut)
        leaves.append(value)
    return Boosted(base, depth, np.array(features), np.array(edges), np.array(leaves))


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray) -> None:
    """Fit slope and shift of the logistic curve by Newton steps with a little ridge."""
    s = model.raw(x)
    w = np.array([1.0, 0.0])
    design = np.stack([s, np.ones_like(s)], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        grad = design.T @ (y - p) - 0.1 * (w - [1.0, 0.0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        w = w + np.linalg.solve(hess, grad)
    if w[0] > 0:
        model.slope, model.shift = float(w[0]), float(w[1])
