"""Small gradient-boosted trees: fitted on a bounded sample, scored as Columns."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: a leaf's value, or (feature, threshold, branch at or below it, branch above)
Tree = float | tuple


@dataclass
class Boosted:
    """Trees for the log-odds of label 1, and the calibrated threshold."""

    start: float = -20.0
    trees: list[Tree] = field(default_factory=list)
    threshold: float = 2.0  # above any probability: selects nothing

    def column(self, features: Column) -> Column:
        """Probability of label 1, for an array column of features."""
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + _tree_column(tree, features)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += _tree_values(tree, x)
        return 1 / (1 + np.exp(-total))


def _tree_column(tree: Tree, features: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    at, cut, low, high = tree
    return F.when(features[at] <= F.lit(float(cut)), _tree_column(low, features)).otherwise(_tree_column(high, features))


def _tree_values(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), float(tree))
    at, cut, low, high = tree
    return np.where(x[:, at] <= cut, _tree_values(low, x), _tree_values(high, x))


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, rate: float, least: int) -> Tree:
    best, whole = None, grad.sum() ** 2 / (hess.sum() + 1.0)
    if depth and len(x) >= 2 * least:
        for at in range(x.shape[1]):
            order = np.argsort(x[:, at], kind="stable")
            v, g, h = x[order, at], np.cumsum(grad[order]), np.cumsum(hess[order])
            ends = np.flatnonzero(v[1:] != v[:-1])
            ends = ends[(ends + 1 >= least) & (len(x) - ends - 1 >= least)]
            if len(ends):
                gain = g[ends] ** 2 / (h[ends] + 1.0) + (g[-1] - g[ends]) ** 2 / (h[-1] - h[ends] + 1.0) - whole
                k = int(np.argmax(gain))
                if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                    best = (gain[k], at, (v[ends[k]] + v[ends[k] + 1]) / 2)
    if best is None:
        return float(rate * grad.sum() / (hess.sum() + 1.0))
    _, at, cut = best
    low = x[:, at] <= cut
    return (at, float(cut), _grow(x[low], grad[low], hess[low], depth - 1, rate, least), _grow(x[~low], grad[~low], hess[~low], depth - 1, rate, least))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 16, depth: int = 2, rate: float = 0.5, least: int = 5) -> Boosted:
    """Newton boosting of the log loss.  One class only: selects nothing."""
    model = Boosted()
    if len(y) < 2 * least or y.min() == y.max():
        return model
    model.start = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = _grow(x, y - p, p * (1 - p), depth, rate, least)
        model.trees.append(tree)
        total += _tree_values(tree, x)
    return model


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray, precision: float, least: int = 20) -> Boosted:
    """Lowest threshold above which held-out rows reach ``precision``; with
    fewer than ``least`` rows above any, nothing is selected."""
    p = model.predict(x)
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True) if len(y) else np.zeros(0, bool)
    ok = np.flatnonzero(last & (right >= precision) & (np.arange(1, len(y) + 1) >= least))
    model.threshold = float(p[order][ok[-1]]) if len(ok) and model.trees else 2.0
    return model
