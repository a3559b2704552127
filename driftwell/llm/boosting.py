"""Gradient boosting over counted cells of discrete features, fitted as two-level trees.

A cell is one combination of feature values with the number of rows and of positive rows that have it: a
sufficient statistic that Spark sums over all rows. Its size is bounded by the product of the features'
values, whatever the number of rows; the trees (two levels, logistic loss) are fitted to it on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 40
RATE = 0.3
RIDGE = 1.0


@dataclass(frozen=True)
class Split:
    feature: int
    most: int  # values up to this one go left
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class Boosted:
    base: float
    trees: tuple[Split | float, ...]

    def raw(self, cells: np.ndarray) -> np.ndarray:
        return self.base + sum((_apply(tree, cells) for tree in self.trees), np.zeros(len(cells)))


def _apply(tree: Split | float, cells: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(cells), tree)
    return np.where(cells[:, tree.feature] <= tree.most, _apply(tree.left, cells), _apply(tree.right, cells))


def _leaf(gradient: np.ndarray, curvature: np.ndarray) -> float:
    return round(float(RATE * gradient.sum() / (curvature.sum() + RIDGE)), 9)


def _grow(cells: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, depth: int) -> Split | float:
    best, gain = None, 1e-9
    total, weight = gradient.sum(), curvature.sum()
    for feature in range(cells.shape[1]) if depth else ():
        values = np.unique(cells[:, feature])
        for most in values[:-1]:
            left = cells[:, feature] <= most
            g, h = gradient[left].sum(), curvature[left].sum()
            better = g**2 / (h + RIDGE) + (total - g) ** 2 / (weight - h + RIDGE) - total**2 / (weight + RIDGE)
            if better > gain:
                best, gain = (feature, int(most), left), better
    if best is None:
        return _leaf(gradient, curvature)
    feature, most, left = best
    sides = [_grow(cells[side], gradient[side], curvature[side], depth - 1) for side in (left, ~left)]
    return Split(feature, most, *sides)


def fit(cells: np.ndarray, rows: np.ndarray, positive: np.ndarray, rounds: int = ROUNDS) -> Boosted:
    """``cells``: (n, features) integers; ``rows`` and ``positive``: how many rows each has, and positive ones."""
    if not len(cells):
        return Boosted(0.0, ())
    share = (positive.sum() + 0.5) / (rows.sum() + 1.0)
    base = round(float(np.log(share / (1 - share))), 9)
    raw, trees = np.full(len(cells), base), []
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-raw))
        tree = _grow(cells, positive - rows * chance, rows * chance * (1 - chance), 2)
        trees.append(tree)
        raw = raw + _apply(tree, cells)
    return Boosted(base, tuple(trees))


def threshold(raw: np.ndarray, rows: np.ndarray, positive: np.ndarray, precision: float) -> float:
    """The lowest score, not under even odds, down to which all rows keep ``precision``; infinity if there is none."""
    levels = np.unique(raw[raw >= 0])[::-1]
    best = float("inf")
    for level in levels:
        kept = raw >= level
        if positive[kept].sum() < precision * rows[kept].sum():
            break
        best = float(level)
    return best
