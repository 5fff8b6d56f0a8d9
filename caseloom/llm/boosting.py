"""Gradient-boosted trees with logistic loss, in numpy: small models fitted on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from caseloom.llm.linear import sigmoid


@dataclass
class Tree:
    """Nodes in level order; a leaf's feature is -1."""

    feature: list[int]
    threshold: list[float]
    low: list[int]
    high: list[int]
    value: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        low, high, value = np.array(self.low), np.array(self.high), np.array(self.value)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(x[rows, feature[node]] <= threshold[node], low[node], high[node])
        return value[at]


#: Cuts tried in a feature at most: between all its values, or at its quantiles if it has more.
BINS = 64


def _cuts(v: np.ndarray) -> np.ndarray:
    values = np.unique(v)
    if len(values) > BINS:
        values = np.unique(np.quantile(v, np.linspace(0, 1, BINS)))
    return (values[1:] + values[:-1]) / 2


def _grow(binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, depth: int, l2: float, least: float) -> Tree:
    """binned: for each row and feature, how many of the feature's cuts are below the value, plus BINS times the feature's number."""
    t = Tree([], [], [], [], [])
    width = binned.shape[1]
    real = np.arange(BINS)[None, :] < np.array([len(c) for c in cuts])[:, None]

    def node(rows: np.ndarray, depth: int) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        me = len(t.feature)
        for column, v in ((t.feature, -1), (t.threshold, 0.0), (t.low, -1), (t.high, -1), (t.value, float(-g / (h + l2)))):
            column.append(v)
        if depth == 0 or len(rows) < 2:
            return me
        at = binned[rows].ravel()
        gl, hl = (np.bincount(at, np.repeat(v[rows], width), minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for v in (grad, hess))
        gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
        gain[~real | (hl < least) | (h - hl < least)] = 0
        best = int(gain.argmax())
        if gain.flat[best] > 1e-6:
            f, k = divmod(best, BINS)
            t.feature[me], t.threshold[me] = f, float(cuts[f][k])
            mask = binned[rows, f] - f * BINS <= k
            t.low[me] = node(rows[mask], depth - 1)
            t.high[me] = node(rows[~mask], depth - 1)
        return me

    node(np.arange(len(binned)), depth)
    return t


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Tree]
    #: Of the calibration: probability = logistic(slope * margin + bias).
    slope: float = 1.0
    bias: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * t.predict(x)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.bias)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, l2: float = 1.0, least: float = 1.0) -> Boosted:
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(mean / (1 - mean))), rate, [])
    margin = np.full(len(x), model.start)
    cuts = [_cuts(x[:, f]) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f]) + f * BINS for f, c in enumerate(cuts)], axis=1)
    for _ in range(trees):
        p = sigmoid(margin)
        t = _grow(binned, cuts, p - y, p * (1 - p), depth, l2, least)
        model.trees.append(t)
        margin += rate * t.predict(x)
    return model
