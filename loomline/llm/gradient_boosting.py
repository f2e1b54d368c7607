"""Gradient-boosted trees for yes/no labels, trained with numpy on the driver
over a small table and turned into native column expressions for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Node:
    """A leaf (``value``) or a split: left where feature <= threshold."""

    value: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None


def _grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, reg: float) -> Node:
    g, h = gradient.sum(), hessian.sum()
    leaf = Node(value=g / (h + reg))
    if depth == 0 or len(x) < 10:
        return leaf
    best = (1e-6, -1, 0.0)
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, cg, ch = x[order, j], np.cumsum(gradient[order]), np.cumsum(hessian[order])
        cut = np.flatnonzero(v[:-1] < v[1:])
        if not len(cut):
            continue
        gl, hl = cg[cut], ch[cut]
        gain = gl**2 / (hl + reg) + (g - gl) ** 2 / (h - hl + reg) - g**2 / (h + reg)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), j, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    if best[1] < 0:
        return leaf
    low = x[:, best[1]] <= best[2]
    return Node(0.0, best[1], best[2], _grow(x[low], gradient[low], hessian[low], depth - 1, reg), _grow(x[~low], gradient[~low], hessian[~low], depth - 1, reg))


def _apply(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    low = x[:, node.feature] <= node.threshold
    out = np.empty(len(x))
    out[low], out[~low] = _apply(node.left, x[low]), _apply(node.right, x[~low])
    return out


def _sql(node: Node, feature: str) -> str:
    if node.feature < 0:
        return f"{float(node.value)!r}D"
    return f"CASE WHEN {feature.format(node.feature)} <= {float(node.threshold)!r}D THEN {_sql(node.left, feature)} ELSE {_sql(node.right, feature)} END"


def _splits(node: Node) -> list[int]:
    return [] if node.feature < 0 else [node.feature, *_splits(node.left), *_splits(node.right)]


@dataclass(frozen=True)
class Boosted:
    base: float
    rate: float
    trees: tuple[Node, ...]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((_apply(t, x) for t in self.trees), np.zeros(len(x)))

    def features_used(self) -> list[int]:
        """The feature of every split."""
        return [f for t in self.trees for f in _splits(t)]

    def sql(self, feature: str) -> str:
        """The logit as a native SQL expression; ``feature`` names a feature by its number, as ``f[{}]``."""
        return " + ".join([f"{float(self.base)!r}D", *(f"{float(self.rate)!r}D * ({_sql(t, feature)})" for t in self.trees)])


def fit(x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 3, rate: float = 0.3, reg: float = 1.0) -> Boosted:
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    score, grown = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grown.append(_grow(x, y - p, p * (1 - p), depth, reg))
        score += rate * _apply(grown[-1], x)
    return Boosted(base, rate, tuple(grown))


def calibrated_threshold(logits: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold at which held-out precision is ``precision`` at
    least: halfway between the lowest logit accepted and the highest rejected.
    Infinite where no threshold reaches it."""
    order = np.argsort(-logits, kind="stable")
    ranked = logits[order]
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ends = np.append(ranked[:-1] > ranked[1:], True)
    good = np.flatnonzero((right >= precision) & ends)
    if not len(good):
        return float("inf")
    last = good[-1]
    return float((ranked[last] + ranked[last + 1]) / 2) if last + 1 < len(ranked) else float(ranked[last] - 1)
