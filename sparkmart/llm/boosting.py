"""Gradient-boosted trees for two classes, small enough to train while a job is planned."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Trees of equal depth in arrays: node k of a tree has children 2k + 1 and 2k + 2."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of x."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            out += value[at - (2**self.depth - 1)]
        return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 5.0) -> Trees:
    """Newton boosting of the logistic loss over feature quantiles."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(x), base)
    inner = 2**depth - 1
    features, limits, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                best = 1e-6
                if len(rows) >= 20:
                    total_g, total_h = g[rows].sum(), h[rows].sum()
                    for f, cut in enumerate(cuts):
                        if not len(cut):
                            continue
                        left_g = np.cumsum(np.bincount(binned[rows, f], g[rows], len(cut) + 1))[:-1]
                        left_h = np.cumsum(np.bincount(binned[rows, f], h[rows], len(cut) + 1))[:-1]
                        gain = left_g**2 / (left_h + ridge) + (total_g - left_g) ** 2 / (total_h - left_h + ridge) - total_g**2 / (total_h + ridge)
                        k = int(gain.argmax())
                        if gain[k] > best:
                            best, feature[node], limit[node] = float(gain[k]), f, cut[k]
                at[rows] = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[leaf]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    return Trees(np.array(features), np.array(limits), np.array(values), base, depth)
