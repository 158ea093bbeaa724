"""Gradient-boosted trees for two classes over binned features, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 80
DEPTH = 3
RATE = 0.1
BINS = 32
SHRINK = 1.0  # added to each leaf's second derivative
LEAST_ROWS = 4  # in a leaf


@dataclass
class Trees:
    """Complete binary trees: node k splits at ``feature[k] < cut[k]``, its children are 2k + 1 and 2k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.intp)
            for _ in range(DEPTH):
                node = 2 * node + 2 - (x[rows, feature[node]] < cut[node])
            out += leaf[node - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees by second-order gain of the logistic loss."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    margin = np.full(len(y), np.log(rate / (1 - rate)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)], axis=1)
    offset = np.arange(x.shape[1]) * BINS
    trees, base = [], float(margin[0]) if len(y) else 0.0
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grown = _grow(binned + offset, p - y, p * (1 - p), x.shape[1])
        feature, cut_bin, leaf, at = grown
        margin += RATE * leaf[at]
        cut = np.array([edges[f][b - 1] if 0 < b <= len(edges[f]) else np.inf for f, b in zip(feature, cut_bin, strict=True)])
        trees.append((feature, cut, RATE * leaf))
    return Trees(base, *(np.stack(parts) for parts in zip(*trees, strict=True)))


def _grow(cells: np.ndarray, first: np.ndarray, second: np.ndarray, n_features: int):
    """One tree: features and bins of its inner nodes, leaf values, each row's leaf."""
    inner = (1 << DEPTH) - 1
    feature, cut = np.zeros(inner, np.intp), np.zeros(inner, np.intp)
    node = np.zeros(len(first), np.intp)
    width = n_features * BINS
    for level in range(DEPTH):
        begin, nodes = (1 << level) - 1, 1 << level
        at = ((node - begin)[:, None] * width + cells).ravel()

        def sums(values: np.ndarray, at=at, nodes=nodes) -> np.ndarray:
            return np.bincount(at, np.repeat(values, n_features), nodes * width).reshape(nodes, n_features, BINS)

        g, h, n = (sums(v).cumsum(axis=2) for v in (first, second, np.ones(len(first))))
        whole = [v[:, :, -1:] for v in (g, h, n)]
        gain = g**2 / (h + SHRINK) + (whole[0] - g) ** 2 / (whole[1] - h + SHRINK) - whole[0] ** 2 / (whole[1] + SHRINK)
        gain = np.where((n >= LEAST_ROWS) & (whole[2] - n >= LEAST_ROWS), gain, 0)
        best = gain.reshape(nodes, -1).argmax(axis=1)
        found = gain.reshape(nodes, -1).max(axis=1) > 1e-9
        feature[begin : begin + nodes] = np.where(found, best // BINS, 0)
        cut[begin : begin + nodes] = np.where(found, best % BINS + 1, BINS)  # BINS: all rows go left
        own = cells[np.arange(len(node)), feature[node]] - feature[node] * BINS
        node = 2 * node + 2 - (own < cut[node])
    at = node - inner
    g, h = np.bincount(at, first, 1 << DEPTH), np.bincount(at, second, 1 << DEPTH)
    return feature, cut, -g / (h + SHRINK), at


@dataclass
class Calibration:
    """A non-decreasing map of margins to probabilities, linear between the middles of equal stretches."""

    margin: np.ndarray
    share: np.ndarray

    def score(self, margin: np.ndarray) -> np.ndarray:
        # a trace of the margin itself keeps the order where the map is flat
        steps = np.interp(margin, self.margin, self.share)
        return np.clip((1 - 1e-6) * steps + 1e-6 / (1 + np.exp(-np.clip(margin, -30, 30))), 0.0, 1.0)


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> Calibration:
    """Pool adjacent violators: means of the label that do not fall with the margin."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # sum of labels, of margins, rows
    for m, label in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        pools.append([label, m, 1.0])
        while len(pools) > 1 and pools[-2][0] * pools[-1][2] >= pools[-1][0] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return Calibration(np.array([s / n for _, s, n in pools]), np.array([a / n for a, _, n in pools]))
