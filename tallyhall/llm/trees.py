"""Gradient-boosted trees with the logistic loss, and isotonic calibration,
for a bounded matrix of dense features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Boosted:
    """Trees as arrays: node k has children 2k+1 and 2k+2; feature -1: leaf."""
    base: float
    rate: float
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while (inner := feature[node] >= 0).any():
                f = np.maximum(feature[node], 0)
                node = np.where(inner, 2 * node + 1 + (x[rows, f] > cut[node]), node)
            z += self.rate * value[node]
        return z


def fit_boosted(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2,
                bins: int = 64, l2: float = 1.0, least: int = 5) -> Boosted:
    """Newton boosting on binned features: each split is the best over all
    features and bin edges by the gain in the second-order loss."""
    edges = [np.unique(np.quantile(c[c > c.min()], np.linspace(0, 1, bins - 1), method="lower"))
             if (c > c.min()).any() else np.zeros(0) for c in x.T]
    edges = [np.concatenate([[c.min()], e])[:-1] if len(e) else e for c, e in zip(x.T, edges)]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Boosted(float(np.log(p / (1 - p))), rate)
    z = np.full(len(y), model.base)
    size = 2 ** (depth + 1) - 1
    for _ in range(rounds):
        prob = _sigmoid(z)
        g, h = y - prob, prob * (1 - prob)
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        node = np.zeros(len(y), np.int64)
        for k in range(size):
            at = np.flatnonzero(node == k)
            if not len(at):
                continue
            sg, sh = g[at].sum(), h[at].sum()
            value[k] = sg / (sh + l2)
            if k >= 2 ** depth - 1 or len(at) < 2 * least:
                continue
            best = (1e-6, -1, 0)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[f, at]
                n = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                gl = np.cumsum(np.bincount(b, g[at], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[at], len(e) + 1))[:-1]
                gain = gl ** 2 / (hl + l2) + (sg - gl) ** 2 / (sh - hl + l2) - sg ** 2 / (sh + l2)
                gain[(n < least) | (n > len(at) - least)] = 0
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (float(gain[j]), f, j)
            if best[1] >= 0:
                feature[k], cut[k] = best[1], edges[best[1]][best[2]]
                node[at] = 2 * k + 1 + (binned[best[1], at] > best[2])
        z += rate * value[node]
        for store, v in ((model.feature, feature), (model.cut, cut), (model.value, value)):
            store.append(v)
    return model


@dataclass
class Calibrated:
    """A margin's chance by linear interpolation between pooled blocks."""
    at: np.ndarray
    chance: np.ndarray
    base: float
    trees: Boosted | None = None

    def of(self, trees: Boosted | None) -> Calibrated:
        self.trees = trees
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.base)
        z = self.trees.margin(x)
        if not len(self.at):
            return _sigmoid(z)
        return np.interp(z, self.at, self.chance)


def fit_isotonic(margin: np.ndarray, y: np.ndarray, base: float) -> Calibrated:
    """Pool adjacent violators; each block counts half a row of either label
    more, so that no chance is exactly 0 or 1."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of margins
    for z, t in zip(margin[order], y[order]):
        blocks.append([t, 1.0, z])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], a)]
    s = np.array(blocks).reshape(-1, 3)
    chance = np.maximum.accumulate((s[:, 0] + 0.5 * base) / (s[:, 1] + 0.5)) if len(s) else np.zeros(0)
    return Calibrated(s[:, 2] / np.maximum(s[:, 1], 1), chance, base)
