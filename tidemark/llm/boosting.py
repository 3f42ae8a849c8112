"""Small gradient-boosted trees for a logistic loss, trained on the driver and scored as a SQL expression."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A leaf (value) or a question: x[feature] <= cut."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def apply(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.cut, self.low.apply(x), self.high.apply(x))

    def sql(self, names: list[str]) -> str:
        if self.feature < 0:
            return f"{self.value:.6g}D"
        return (
            f"IF({names[self.feature]} <= {self.cut:.6g}D, "
            f"{self.low.sql(names)}, {self.high.sql(names)})"
        )


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> Tree:
    leaf = Tree(float(g.sum() / (h.sum() + 1.0)))
    if not depth or len(g) < 4:
        return leaf
    best = (1e-3, -1, 0.0)
    base = g.sum() ** 2 / (h.sum() + 1)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        gs, hs = np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - base
        gain[v[1:] == v[:-1]] = -1
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float((v[k] + v[k + 1]) / 2))
    if best[1] < 0:
        return leaf
    low = x[:, best[1]] <= best[2]
    return Tree(0.0, best[1], best[2], _grow(x[low], g[low], h[low], depth - 1), _grow(x[~low], g[~low], h[~low], depth - 1))


@dataclass
class Boosted:
    start: float
    trees: list[Tree]
    rate: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.rate * sum((t.apply(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(x) + self.shift)))

    def sql(self, names: list[str]) -> str:
        total = " + ".join(t.sql(names) for t in self.trees) or "0D"
        return f"1D / (1D + exp(-({self.slope:.6g}D * ({self.start:.6g}D + {self.rate:.6g}D * ({total})) + {self.shift:.6g}D)))"


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3) -> Boosted:
    """Fit on the even rows, and a logistic calibration on the odd ones."""
    fit_x, fit_y, cal_x, cal_y = x[::2], y[::2], x[1::2], y[1::2]
    p = min(max(fit_y.mean(), 0.01), 0.99)
    model = Boosted(math.log(p / (1 - p)), [], rate)
    margin = np.full(len(fit_y), model.start)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        tree = _grow(fit_x, fit_y - q, q * (1 - q), depth)
        model.trees.append(tree)
        margin += rate * tree.apply(fit_x)
    m = model.margin(cal_x)
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-(a * m + b)))
        w = q * (1 - q)
        grad = np.array([((cal_y - q) * m).sum() - 0.05 * (a - 1), (cal_y - q).sum() - 0.05 * b])
        hess = np.array([[(w * m * m).sum() + 0.05, (w * m).sum()], [(w * m).sum(), w.sum() + 0.05]])
        step = np.linalg.solve(hess, grad)
        a, b = a + float(step[0]), b + float(step[1])
    model.slope, model.shift = a, b
    return model


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which on the share of ones is at least `precision`; 1.0 if there is none."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(share >= precision)
    return float(p[order][good[-1]]) if len(good) else 1.0
