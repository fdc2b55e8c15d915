"""Gradient-boosted trees with logistic loss, for training sets that fit the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Trees as lists of (feature, threshold) by level order; leaves hold log-odds."""

    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    cuts: int = 24
    base: float = 0.0
    splits: list[list[tuple[int, float]]] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.cuts + 1)[1:-1])) for j in range(x.shape[1])]
        sides = [(j, t, x[:, j] > t) for j, ts in enumerate(edges) for t in ts if 0 < (x[:, j] > t).sum() < len(x)]
        above = np.array([s for _, _, s in sides], float).reshape(len(sides), len(x))
        score = np.full(len(x), self.base)
        for _ in range(self.trees if sides else 0):
            p = 1 / (1 + np.exp(-score))
            gradient, hessian = y - p, p * (1 - p)
            node = np.zeros(len(x), int)
            splits: list[tuple[int, float]] = []
            for level in range(self.depth):
                for n in range(2**level):
                    inside = node == n + 2**level - 1
                    g, h = gradient * inside, hessian * inside
                    right_g, right_h = above @ g, above @ h
                    left_g, left_h = g.sum() - right_g, h.sum() - right_h
                    gain = right_g**2 / (right_h + 1) + left_g**2 / (left_h + 1)
                    best = int(gain.argmax())
                    splits.append(sides[best][:2])
                    node[inside] = 2 * (n + 2**level - 1) + 1 + sides[best][2][inside]
            first = 2**self.depth - 1
            g = np.bincount(node - first, gradient, 2**self.depth)
            h = np.bincount(node - first, hessian, 2**self.depth)
            leaf = self.rate * g / (h + 1)
            self.splits.append(splits)
            self.leaves.append(leaf)
            score = score + leaf[node - first]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for splits, leaves in zip(self.splits, self.leaves, strict=True):
            node = np.zeros(len(x), int)
            feature = np.array([s[0] for s in splits])
            threshold = np.array([s[1] for s in splits])
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
            score += leaves[node - len(splits)]
        return score
