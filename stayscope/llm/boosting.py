"""Gradient-boosted trees for two classes on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Trees as arrays: feature and cut per inner node of a full binary tree, a value per leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - (len(value) - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 24, ridge: float = 1.0,
) -> Trees:
    """Boost trees on the logistic loss; a cut is the best of `bins` quantiles of a feature."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    share = np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    z, inner = np.full(n, base), 2**depth - 1
    features, splits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            choice = [None] * count
            for j in range(m):
                if not len(cuts[j]):
                    continue
                key, width = (at - first) * (bins + 1) + binned[:, j], count * (bins + 1)
                gs = np.bincount(key, g, width).reshape(count, bins + 1).cumsum(1)
                hs = np.bincount(key, h, width).reshape(count, bins + 1).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain = gain[:, : len(cuts[j])]
                where = gain.argmax(1)
                for i in np.flatnonzero(gain[np.arange(count), where] > best):
                    best[i], choice[i] = gain[i, where[i]], (j, cuts[j][where[i]])
            for i, c in enumerate(choice):
                if c:
                    feature[first + i], cut[first + i] = c
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf = at - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        z = z + value[leaf]
        features.append(feature), splits.append(cut), values.append(value)
    return Trees(np.array(features), np.array(splits), np.array(values), base)
