"""Histogram gradient-boosted trees, flattened for vectorised numpy traversal.

Fitting runs on the driver over a bounded sample (the callers' documented
parameter); the fitted model is a few small arrays and is what tasks get.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Forest:
    """All trees as flat arrays; a leaf's children are itself."""
    bias: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        """Probabilities of label 1."""
        out = np.full(len(x), self.bias)
        if not len(self.roots):
            return _sigmoid(out)
        for lo in range(0, len(x), block):
            part = x[lo:lo + block]
            row = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                go_left = part[row, self.feature[at]] <= self.threshold[at]
                at = np.where(go_left, self.left[at], self.right[at])
            out[lo:lo + block] += self.value[at].sum(axis=1)
        return _sigmoid(out)


def _edges(col: np.ndarray, bins: int) -> np.ndarray:
    u = np.unique(col)
    if len(u) <= bins:
        return (u[:-1] + u[1:]) / 2
    return np.unique(np.quantile(col, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, bins: int = 64,
        rate: float = 0.15, l2: float = 1.0, least: int = 10) -> Forest:
    """Logistic loss, level-wise trees over binned features.

    No rows, or one label only, gives a forest without trees (its bias is
    the smoothed share of label 1).
    """
    n, m = x.shape
    prior = (float(y.sum()) + 0.5) / (n + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [_edges(x[:, j], bins) for j in range(m)]
        binned = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
        score = np.full(n, bias)
        for _ in range(rounds):
            p = _sigmoid(score)
            g, h = p - y, p * (1 - p)
            new = lambda: (feature.append(0), threshold.append(np.inf), value.append(0.0),
                           left.append(len(feature) - 1), right.append(len(feature) - 1))
            new()
            roots.append(len(feature) - 1)
            node = np.full(n, roots[-1])
            open_nodes = [roots[-1]]
            for _level in range(depth):
                slot = np.full(len(feature), -1)
                slot[open_nodes] = np.arange(len(open_nodes))
                s = slot[node]
                live = s >= 0
                k = len(open_nodes)
                best = [(1e-9, -1, -1)] * k
                for j in range(m):
                    b = len(edges[j]) + 1
                    if b < 2:
                        continue
                    at = s[live] * b + binned[j][live]
                    gs = np.bincount(at, g[live], k * b).reshape(k, b).cumsum(1)
                    hs = np.bincount(at, h[live], k * b).reshape(k, b).cumsum(1)
                    cs = np.bincount(at, minlength=k * b).reshape(k, b).cumsum(1)
                    gt, ht, ct = gs[:, -1:], hs[:, -1:], cs[:, -1:]
                    gain = (gs**2 / (hs + l2) + (gt - gs)**2 / (ht - hs + l2) - gt**2 / (ht + l2))
                    gain[(cs < least) | (ct - cs < least)] = -1
                    for i, c in enumerate(gain[:, :-1].argmax(1)):
                        if gain[i, c] > best[i][0]:
                            best[i] = (gain[i, c], j, c)
                nxt = []
                for i, (_, j, c) in enumerate(best):
                    if j < 0:
                        continue
                    at = open_nodes[i]
                    feature[at], threshold[at] = j, edges[j][c]
                    for side in (left, right):
                        new()
                        side[at] = len(feature) - 1
                        nxt.append(len(feature) - 1)
                    mine = node == at
                    node[mine] = np.where(binned[j][mine] <= c, left[at], right[at])
                if not nxt:
                    break
                open_nodes = nxt
            gs, hs = np.bincount(node, g, len(feature)), np.bincount(node, h, len(feature))
            for at in np.unique(node):
                value[at] = -rate * gs[at] / (hs[at] + l2)
            score += np.array(value)[node]
    return Forest(bias, np.array(roots, np.int32), np.array(feature, np.int32),
                  np.array(threshold, np.float64), np.array(left, np.int32),
                  np.array(right, np.int32), np.array(value, np.float64), depth)


def isotonic(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Calibration steps by pool-adjacent-violators: (score knots, rates).  With
    ``n`` an entry stands for so many rows, ``y`` of them positive."""
    if not len(score):
        return np.zeros(1), np.zeros(1)
    o = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    n = np.ones(len(score)) if n is None else n
    for s, v, w in zip(score[o].tolist(), y[o].astype(float).tolist(), n[o].astype(float).tolist()):
        blocks.append([s, v, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            b = blocks.pop()
            blocks[-1] = [b[0], blocks[-1][1] + b[1], blocks[-1][2] + b[2]]
    return (np.array([b[0] for b in blocks]),
            np.array([(b[1] + 0.5) / (b[2] + 1.0) for b in blocks]))


def calibrated(score: np.ndarray, knots: np.ndarray, rates: np.ndarray) -> np.ndarray:
    return np.interp(score, knots, rates)
