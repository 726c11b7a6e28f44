"""Gradient-boosted trees with monotone features, kept as flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class FlatTrees:
    """All trees in one set of arrays; a leaf has feature -1 and points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row of ``x``: all rows walk one level of a tree at a time."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    *,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 1.0,
    least: int = 5,
) -> FlatTrees:
    """Fit log-loss by Newton steps on quantile-binned features.

    ``monotone`` has -1, 0 or 1 per feature. A split on a constrained feature must
    order its children, and their midpoint bounds all values below, so the whole
    model is monotone in that feature.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    rate_of_ones = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(n, bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, start in ((feature, 0), (threshold, np.inf), (value, 0.0)):
            column.append(start)
        left.append(len(left))
        right.append(len(right))
        return len(feature) - 1

    def weight(g: np.ndarray | float, h: np.ndarray | float, low: float, high: float) -> np.ndarray | float:
        return np.clip(-g / (h + ridge), low, high)

    def grow(at: int, rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-9, None)
        if level < depth and len(rows) >= 2 * least:
            own = weight(total_g, total_h, low, high)
            loss = lambda a, b, w: a * w + 0.5 * (b + ridge) * w * w
            for f in range(width):
                size = len(edges[f]) + 1
                if size < 2:
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                count = np.cumsum(np.bincount(b, minlength=size))[:-1]
                wl, wr = weight(gl, hl, low, high), weight(total_g - gl, total_h - hl, low, high)
                gain = loss(total_g, total_h, own) - loss(gl, hl, wl) - loss(total_g - gl, total_h - hl, wr)
                bad = (count < least) | (len(rows) - count < least) | (monotone[f] * (wr - wl) < 0)
                gain = np.where(bad, -np.inf, gain)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, float(wl[k]), float(wr[k])))
        if best[1] is None:
            value[at] = rate * float(weight(total_g, total_h, low, high))
            return
        f, k, wl, wr = best[1]
        mid = (wl + wr) / 2
        feature[at], threshold[at] = f, edges[f][k]
        goes_left = binned[rows, f] <= k
        left[at], right[at] = node(), node()
        bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[int(monotone[f])]
        grow(left[at], rows[goes_left], g, h, level + 1, *bounds[0])
        grow(right[at], rows[~goes_left], g, h, level + 1, *bounds[1])

    def flat() -> FlatTrees:
        return FlatTrees(
            np.array(feature, np.int64), np.array(threshold, float), np.array(left, np.int64),
            np.array(right, np.int64), np.array(value, float), np.array(roots, np.int64), depth, bias,
        )

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        root = node()
        grow(root, np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf)
        roots.append(root)
        one = FlatTrees(
            np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value),
            np.array([root]), depth, 0.0,
        )
        margin += one.margin(x)
    return flat()
