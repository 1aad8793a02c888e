"""Gradient-boosted trees with logistic loss and isotonic calibration, fitted on
the driver over a bounded sample of feature rows."""

from __future__ import annotations

import numpy as np


class Trees:
    """Complete trees of one depth: node ``i`` has children ``2i+1``, ``2i+2``;
    a row goes left if its feature is at most the threshold."""

    def __init__(self, base: float, features: np.ndarray, thresholds: np.ndarray, leaves: np.ndarray):
        self.base, self.features, self.thresholds, self.leaves = base, features, thresholds, leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range((len(feature) + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, damping: float = 1.0, least: float = 1.0, start: np.ndarray | None = None) -> Trees:
    """Newton boosting over binned features, from the rows' margins ``start`` if
    given; deterministic."""
    n, m = x.shape
    share = min(max(float(y.mean()) if n else 0.0, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share))) if start is None else 0.0
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(m)]
    cuts = [np.unique(np.concatenate([c, [0.0]])) for c in cuts]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1) if m else np.zeros((n, 0), int)
    width = max((len(c) for c in cuts), default=0) + 1
    inner = 2**depth - 1
    margin = np.full(n, base) if start is None else np.array(start, float)
    features, thresholds, leaves = [], [], []
    for _ in range(rounds if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first = 2**level - 1
            for at in range(first, 2 * first + 1):
                of = np.nonzero(node == at)[0]
                if not len(of):
                    continue
                best = (1e-9, 0, np.inf, 0)
                total_g, total_h = g[of].sum(), h[of].sum()
                for j in range(m):
                    sg = np.cumsum(np.bincount(binned[of, j], weights=g[of], minlength=width))[: len(cuts[j])]
                    sh = np.cumsum(np.bincount(binned[of, j], weights=h[of], minlength=width))[: len(cuts[j])]
                    rg, rh = total_g - sg, total_h - sh
                    gain = sg**2 / (sh + damping) + rg**2 / (rh + damping) - total_g**2 / (total_h + damping)
                    gain[(sh < least * 1e-3) | (rh < least * 1e-3)] = 0
                    if len(gain) and gain.max() > best[0]:
                        k = int(gain.argmax())
                        best = (float(gain[k]), j, float(cuts[j][k]), k)
                feature[at], threshold[at] = best[1], best[2]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        slot = node - inner
        leaf = -rate * np.bincount(slot, weights=g, minlength=inner + 1) / (np.bincount(slot, weights=h, minlength=inner + 1) + damping)
        margin += leaf[slot]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    shape = (len(features), inner)
    return Trees(base, np.array(features, np.int64).reshape(shape), np.array(thresholds, float).reshape(shape), np.array(leaves, float).reshape(len(features), inner + 1))


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: ascending margins and their probabilities, each
    block smoothed by a tenth of a row of either label. Linear in between."""
    if not len(margin):
        return np.array([0.0]), np.array([0.5])
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum, count, lowest, highest margin
    for m, v in zip(margin[order].tolist(), y[order].tolist()):
        if blocks and blocks[-1][3] == m:  # equal margins share one value
            blocks[-1][0] += v
            blocks[-1][1] += 1
        else:
            blocks.append([v, 1, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            v2, n2, _, hi = blocks.pop()
            blocks[-1][0] += v2
            blocks[-1][1] += n2
            blocks[-1][3] = hi
    xs, ps = [], []
    for v, n, lo, hi in blocks:
        p = (v + 0.1) / (n + 0.2)
        for at in dict.fromkeys((lo, hi)):
            xs.append(at)
            ps.append(p)
    return np.array(xs), np.maximum.accumulate(np.array(ps))
