"""Small gradient-boosted trees (logistic loss, histogram splits) in numpy."""

from __future__ import annotations

import numpy as np


def train_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n_trees: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 24) -> dict:
    """Complete trees as arrays: split feature and threshold per inner node, value per leaf."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, threshold, value = np.zeros((n_trees, inner), int), np.full((n_trees, inner), np.inf), np.zeros((n_trees, leaves))
    f = np.zeros(len(x))
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-f))
        g, h = weight * (y - p), weight * p * (1 - p)
        at = np.zeros(len(x), int)
        for level in range(depth):
            first = (1 << level) - 1
            for node in range(first, 2 * first + 1):
                rows = np.flatnonzero(at == node)
                best = (1e-6, 0, np.inf)
                if len(rows):
                    total_g, total_h = g[rows].sum(), h[rows].sum()
                    for j, e in enumerate(edges):
                        if not len(e):
                            continue
                        left_g = np.cumsum(np.bincount(binned[rows, j], g[rows], len(e) + 1))[:-1]
                        left_h = np.cumsum(np.bincount(binned[rows, j], h[rows], len(e) + 1))[:-1]
                        gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], j, e[k])
                feature[t, node], threshold[t, node] = best[1], best[2]
                at[rows] = 2 * node + 1 + (x[rows, best[1]] > best[2])
        leaf = at - inner
        value[t] = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        f += value[t][leaf]
    return {"feature": feature, "threshold": threshold, "value": value, "depth": depth}


def tree_logits(model: dict, x: np.ndarray) -> np.ndarray:
    """Sum of leaf values of every row."""
    out, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, value in zip(model["feature"], model["threshold"], model["value"]):
        at = np.zeros(len(x), int)
        for _ in range(model["depth"]):
            at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
        out += value[at - len(feature)]
    return out
