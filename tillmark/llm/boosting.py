"""Gradient-boosted trees for two classes, over quantile bins, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 50
DEPTH = 4
RATE = 0.25
BINS = 24
RIDGE = 1.0
LEAST_WEIGHT = 2.0


@dataclass
class Boosted:
    """Full binary trees as arrays: the feature and the threshold of each inner node, the value of each leaf."""

    prior: float
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - (2**DEPTH - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Boosted:
    """Trees that lower the logistic loss one after the other; ties of splits go to the first feature and bin."""
    n, d = x.shape
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(1) for j in range(d)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]) if n else np.zeros((0, d), int)
    inner = 2**DEPTH - 1
    features, thresholds, leaves = [], [], []
    score = np.full(n, prior)
    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(n, dtype=np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = at - first
            best = np.full(width, 1e-6)
            for j in range(d):
                key = local * (BINS + 1) + binned[:, j]
                g = np.bincount(key, gradient, width * (BINS + 1)).reshape(width, -1)
                h = np.bincount(key, weight, width * (BINS + 1)).reshape(width, -1)
                gl, hl = g.cumsum(1), h.cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                gain[(hl < LEAST_WEIGHT) | (ha - hl < LEAST_WEIGHT)] = 0
                gain = gain[:, : len(edges[j])]
                if not gain.shape[1]:
                    continue
                k = gain.argmax(1)
                for node in np.flatnonzero(gain[np.arange(width), k] > best):
                    best[node] = gain[node, k[node]]
                    feature[first + node], threshold[first + node] = j, edges[j][k[node]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
        value = -RATE * g / (h + RIDGE)
        score += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return Boosted(prior, np.array(features, dtype=np.int64).reshape(-1, inner), np.array(thresholds).reshape(-1, inner), np.array(leaves).reshape(-1, inner + 1))
