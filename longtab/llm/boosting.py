"""Gradient-boosted regression trees for small tables (logistic loss, exact splits on binned columns).

Training runs on a bounded sample; scoring is vectorised numpy, so tasks score their own rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Boosted:
    prior: float
    trees: list  # each: (feature, threshold, value) arrays of a complete binary tree; feature -1 = leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                f = np.maximum(feature[at], 0)
                at = np.where(inner, 2 * at + 1 + (x[rows, f] > threshold[at]), at)
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2,
        leaf: float = 4.0, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Boost ``trees`` Newton-step trees; ``leaf`` is the least hessian weight times 4 of a leaf's rows."""
    p = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
    model = Boosted(float(np.log(p / (1 - p))), [])
    if len(y) < 2 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), model.prior)
    size = 2 ** (depth + 1) - 1
    for _ in range(trees):
        prob = _sigmoid(margin)
        grad, hess = y - prob, np.maximum(prob * (1 - prob), 1e-6)
        feature, threshold, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        at = np.zeros(len(y), dtype=np.int64)
        for node in range(size):
            own = np.flatnonzero(at == node)
            if not len(own):
                continue
            g, h = grad[own].sum(), hess[own].sum()
            value[node] = rate * g / (h + ridge)
            if 2 * node + 2 >= size:
                continue
            best = 1e-6
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                gs = np.cumsum(np.bincount(binned[own, f], grad[own], len(cut) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[own, f], hess[own], len(cut) + 1))[:-1]
                gain = gs ** 2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g ** 2 / (h + ridge)
                gain[(hs * 4 < leaf * 0.01) | ((h - hs) * 4 < leaf * 0.01)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, feature[node], threshold[node] = gain[k], f, cut[k]
            if feature[node] >= 0:
                at[own] = 2 * node + 1 + (x[own, feature[node]] > threshold[node])
        model.trees.append((feature, threshold, value))
        margin += value[at]
    return model


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling (a, b): probability = sigmoid(a * margin + b), by Newton steps on held-out rows."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = _sigmoid(a * margin + b)
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((y - p) * margin).sum() - 1e-2 * (a - 1), (y - p).sum() - 1e-2 * b])
        h = np.array([[(w * margin ** 2).sum() + 1e-2, (w * margin).sum()],
                      [(w * margin).sum(), w.sum() + 1e-2]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
    return float(a), float(b)


def threshold_for(prob: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The smallest score at which held-out rows at or above it reach ``precision``; above 1 if none does."""
    order = np.argsort(-prob, kind="stable")
    hit = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.r_[prob[order][1:] != prob[order][:-1], True] if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((hit >= precision) & last)
    return float(prob[order][good[-1]]) if len(good) else 2.0
