"""Gradient-boosted trees on binned features, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Perfect binary trees of one depth; node k has the children 2k + 1 and 2k + 2."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes): bins up to it go left
    leaf: np.ndarray  # (trees, leaves)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of features."""
        b = binned(x, self.edges)
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value."""
    return np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32,
          smooth: float = 1.0, least: float = 1.0, weight: np.ndarray | None = None) -> Trees:
    """Newton steps on the logistic loss; the split with the most gain in each node of a level, if it
    gains ``least`` and leaves as much curvature on either side.  ``weight``: of each row (1)."""
    weight = np.ones(len(y)) if weight is None else weight
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    b, (n, f) = binned(x, edges), x.shape
    share = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
    base, inner, leaves = float(np.log(share / (1 - share))), 2 ** depth - 1, 2 ** depth
    raw = np.full(n, base)
    feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), bins)
    leaf = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            cell = (((node - first)[:, None] * f + np.arange(f)) * (bins + 1) + b).ravel()
            shape = (width, f, bins + 1)
            sums_g = np.bincount(cell, np.repeat(g, f), width * f * (bins + 1)).reshape(shape).cumsum(2)
            sums_h = np.bincount(cell, np.repeat(h, f), width * f * (bins + 1)).reshape(shape).cumsum(2)
            all_g, all_h = sums_g[..., -1:], sums_h[..., -1:]

            def gain(a, c):
                return a * a / (c + smooth)

            value = gain(sums_g, sums_h) + gain(all_g - sums_g, all_h - sums_h) - gain(all_g, all_h)
            value = np.where((sums_h >= least) & (all_h - sums_h >= least), value, 0.0)
            best = value.reshape(width, -1).argmax(1)
            found = value.reshape(width, -1)[np.arange(width), best] >= least
            nodes = first + np.arange(width)
            feature[t, nodes] = np.where(found, best // (bins + 1), 0)
            cut[t, nodes] = np.where(found, best % (bins + 1), bins)
            node = 2 * node + 1 + (b[np.arange(n), feature[t, node]] > cut[t, node])
        at = node - inner
        leaf[t] = rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + smooth)
        raw += leaf[t][at]
    return Trees(edges, base, feature, cut, leaf)


def isotonic(score: np.ndarray, y: np.ndarray, prior: float = 0.0,
             weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, share of ones), both non-decreasing.  ``prior``: so many
    rows with the average share are added to each pool, so that a small one says little.  ``weight``: rows that each one stands for (1)."""
    weight = np.ones(len(y)) if weight is None else weight
    values, group = np.unique(score, return_inverse=True)  # rows of one score stay together
    all_ones, all_rows = np.bincount(group, y * weight), np.bincount(group, weight)
    blocks: list[list[float]] = []  # ones, rows, lowest and highest score
    for s, one, n in zip(values, all_ones, all_rows):
        blocks.append([float(one), float(n), s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            ones, rows, _, high = blocks.pop()
            blocks[-1][0] += ones
            blocks[-1][1] += rows
            blocks[-1][3] = high
    xs = np.array([v for b in blocks for v in (b[2], b[3])])
    ys = np.array([(b[0] + prior * np.average(y, weights=weight)) / (b[1] + prior) for b in blocks for _ in (0, 1)])
    ys = np.maximum.accumulate(ys)
    return xs, ys
