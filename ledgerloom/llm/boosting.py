"""Gradient boosted trees with logistic loss over binned features, and Platt calibration."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class BoostedTrees:
    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        at = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], at)) for j in range(x.shape[1])]
        binned = self._binned(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        self.grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        margin = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = sigmoid(margin)
            tree = self._grow(binned, p - y, np.maximum(p * (1 - p), 1e-6))
            self.grown.append(tree)
            margin += self._leaf(tree, binned)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def _grow(self, binned, gradient, curvature):
        """A full tree: node ``i`` has the children ``2 i + 1`` (bin at most the cut) and ``2 i + 2``."""
        n, width = binned.shape
        inner = 2**self.depth - 1
        feature, cut = np.zeros(inner, int), np.full(inner, self.bins)
        node = np.zeros(n, int)
        for level in range(self.depth):
            low, count = 2**level - 1, 2**level
            cell = ((node - low)[:, None] * width + np.arange(width)) * self.bins + binned
            shape, size = (count, width, self.bins), count * width * self.bins
            g = np.bincount(cell.ravel(), np.repeat(gradient, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(cell.ravel(), np.repeat(curvature, width), size).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + self.ridge) + (all_g - g) ** 2 / (all_h - h + self.ridge)
            best = gain.reshape(count, -1).argmax(axis=1)
            feature[low : low + count], cut[low : low + count] = best // self.bins, best % self.bins
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, curvature, inner + 1)
        return feature, cut, -self.rate * g / (h + self.ridge)

    def _leaf(self, tree, binned) -> np.ndarray:
        feature, cut, value = tree
        node, row = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(self.depth):
            node = 2 * node + 1 + (binned[row, feature[node]] > cut[node])
        return value[node - len(cut)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.start + sum((self._leaf(t, binned) for t in self.grown), np.zeros(len(x)))


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept that turn held-out margins into probabilities (Newton's method)."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))

    def sums(a: float, b: float) -> tuple:
        p = sigmoid(a * margin + b)
        w = np.maximum(p * (1 - p), 1e-6)
        return ((p - target) * margin).sum(), (p - target).sum(), (w * margin**2).sum(), (w * margin).sum(), w.sum()

    return platt_by_sums(sums, steps)


def platt_by_sums(sums: Callable[[float, float], tuple], steps: int = 50) -> tuple[float, float]:
    """The same where ``sums`` adds up gradient and curvature for a slope and an intercept."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        by_slope, by_shift, slopes, both, shifts = sums(a, b)
        gradient = np.array([by_slope + 1e-3 * (a - 1), by_shift])
        hessian = np.array([[slopes + 1e-3, both], [both, shifts + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def precise_threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which on held-out candidates have that precision."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= precision)
    return float(max(0.5, p[order][good[-1]])) if len(good) else 1.1


def recall_threshold(p: np.ndarray, y: np.ndarray, recall: float) -> float:
    """The highest probability that still keeps that share of the held-out positives."""
    own = np.sort(p[y > 0])
    return float(own[int((1 - recall) * len(own))]) if len(own) else 1.1
