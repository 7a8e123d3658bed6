"""Gradient-boosted trees for a yes or no, on histograms, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A full binary tree as arrays; a split sends values of at most ``cut`` to the left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray  # of the leaves
    depth: int

    def of(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.cut[at])
        return self.value[at - len(self.feature)]


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree.of(x)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _grown(codes: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> Tree:
    """One tree by the gradients ``g`` and weights ``h``; ``codes`` are the bins of the values."""
    bins = max(len(c) for c in cuts) + 1
    splits = 2**depth - 1
    feature, cut, at = np.zeros(splits, np.int64), np.full(splits, np.inf), np.zeros(len(g), np.int64)
    for level in range(depth):
        first, nodes = 2**level - 1, 2**level
        best = np.zeros(nodes)
        for f in range(codes.shape[1]):
            cell = (at - first) * bins + codes[:, f]
            left_g, left_h = (np.bincount(cell, v, nodes * bins).reshape(nodes, bins).cumsum(1) for v in (g, h))
            all_g, all_h = left_g[:, -1:], left_h[:, -1:]
            gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < least) | (all_h - left_h < least)] = 0
            gain = gain[:, : len(cuts[f])]
            if not gain.shape[1]:
                continue
            top = gain.argmax(1)
            better = gain[np.arange(nodes), top] > best + 1e-9
            best[better] = gain[np.arange(nodes), top][better]
            feature[first : first + nodes][better] = f
            cut[first : first + nodes][better] = cuts[f][top[better]]
        position = np.array([np.searchsorted(cuts[f], c) if np.isfinite(c) else bins for f, c in zip(feature, cut)])
        at = 2 * at + 1 + (codes[np.arange(len(g)), feature[at]] > position[at])
    leaves = at - splits
    value = np.bincount(leaves, g, splits + 1) / (np.bincount(leaves, h, splits + 1) + ridge)
    return Tree(feature, cut, value, depth)


def boost(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
    ridge: float = 1.0, least: float = 1.0,
) -> Boosted:
    """Fit trees one after another to the gradient of the logistic loss; ``weight`` counts rows that are alike."""
    share = np.clip(weight @ y / max(weight.sum(), 1e-9), 1e-4, 1 - 1e-4)
    model = Boosted(float(np.log(share / (1 - share))), [])
    if not len(x) or y.min() == y.max():
        return model
    # A value up to a cut goes left; the largest value needs none.
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[:-1], method="lower")) for column in x.T]
    cuts = [c[c < column.max()] for c, column in zip(cuts, x.T)]
    codes = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T)], axis=1)
    total = np.full(len(x), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        tree = _grown(codes, cuts, weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6), depth, ridge, least)
        tree.value = tree.value * rate
        model.trees.append(tree)
        total += tree.of(x)
    return model
