"""Gradient-boosted trees for two classes, small enough to train on the driver in a second."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees as flat arrays: a node is (feature, threshold, left, right, value)."""

    bias: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        flat, start = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        for feature, threshold, left, right, value in self.trees:
            # A leaf leads to itself.
            leaf = feature < 0
            own = np.arange(len(feature))
            f, low, high = np.where(leaf, 0, feature), np.where(leaf, own, left), np.where(leaf, own, right)
            at = np.zeros(len(x), np.int64)
            while not leaf[at].all():
                at = np.where(flat[start + f[at]] <= threshold[at], low[at], high[at])
            out += value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 32, least: int = 8) -> Boosted:
    """Newton boosting of logistic loss over quantile bins; deterministic."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    width = bins + 1
    shifted, ones = binned + np.arange(len(edges)) * width, np.ones(len(y))
    beyond = np.arange(width) >= np.array([len(e) for e in edges])[:, None]
    p0 = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(p0 / (1 - p0)))
    margin, trees = np.full(len(y), bias), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        nodes: list[list] = []

        def grow(rows: np.ndarray, level: int) -> int:
            at = len(nodes)
            gs, hs = g[rows].sum(), h[rows].sum()
            nodes.append([-1, 0.0, 0, 0, -rate * gs / (hs + 1.0)])
            if level == depth or len(rows) < 2 * least:
                return at
            # All features at once: bins of feature j start at j * width.
            flat = shifted[rows].ravel()
            gl, hl, n = (np.bincount(flat, np.repeat(v, len(edges)), len(edges) * width).reshape(-1, width).cumsum(axis=1) for v in (g[rows], h[rows], ones[rows]))
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            gain[(n < least) | (len(rows) - n < least) | beyond] = -1
            k = int(gain.argmax())
            best = (float(gain.flat[k]), k // width, k % width) if gain.flat[k] > 1e-3 else (0.0, -1, 0)
            if best[1] < 0:
                return at
            _, j, k = best
            goes = binned[rows, j] <= k
            nodes[at][0], nodes[at][1] = j, float(edges[j][k])
            nodes[at][2] = grow(rows[goes], level + 1)
            nodes[at][3] = grow(rows[~goes], level + 1)
            return at

        grow(np.arange(len(y)), 0)
        columns = list(zip(*nodes))
        tree = (np.array(columns[0]), np.array(columns[1]), np.array(columns[2]), np.array(columns[3]), np.array(columns[4]))
        trees.append(tree)
        margin = margin + Boosted(0.0, [tree]).margin(x)
    return Boosted(bias, trees)
