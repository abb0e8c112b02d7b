"""Gradient-boosted trees for a binary label, small enough to train on the driver."""

from __future__ import annotations

import numpy as np


class Trees:
    """Full binary trees of equal depth: features and thresholds by node in heap order, leaf values."""

    def __init__(self, bias, features, thresholds, leaves):
        self.bias, self.features, self.thresholds, self.leaves = bias, features, thresholds, leaves

    def logit(self, x):
        """Log-odds of label 1 of each row."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1]))
        for f, t, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def fit(x, y, n_trees=60, depth=4, rate=0.25, bins=24, ridge=1.0) -> Trees:
    """Newton boosting of the logistic loss over quantile bins; no randomness."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    # Features with one cut, such as bits, are summed as one matrix product.
    bits = [j for j, c in enumerate(cuts) if len(c) == 1]
    low = np.stack([x[:, j] <= cuts[j][0] for j in bits]).astype(float) if bits else np.zeros((0, len(y)))
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    score = np.full(len(y), bias)
    inner, n_leaves = 2**depth - 1, 2**depth
    all_f, all_t, all_v = [], [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            # All nodes of a level at once: sums by node and bin, then the best cut of each node.
            first, size = 2**level - 1, 2**level
            place = node - first
            rows = np.bincount(place, minlength=size)
            total_g, total_h = np.bincount(place, g, size), np.bincount(place, h, size)
            whole = total_g**2 / (total_h + ridge)
            spread = np.zeros((len(y), 2 * size))
            spread[np.arange(len(y)), place], spread[np.arange(len(y)), size + place] = g, h
            below = dict(zip(bits, (low @ spread).reshape(-1, 2, size, 1), strict=True))
            best, feature, cut = np.full(size, 1e-6), np.full(size, -1), np.zeros(size, np.int64)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                at = place * (len(c) + 1) + code[:, j] if len(c) > 1 else None
                left_g, left_h = below[j] if at is None else (np.cumsum(np.bincount(at, v, size * (len(c) + 1)).reshape(size, -1), axis=1)[:, :-1] for v in (g, h))
                gain = left_g**2 / (left_h + ridge) + (total_g[:, None] - left_g) ** 2 / (total_h[:, None] - left_h + ridge) - whole[:, None]
                top = gain.argmax(axis=1)
                value = gain[np.arange(size), top]
                better = (value > best) & (rows > 1)
                best[better], feature[better], cut[better] = value[better], j, top[better]
            for k in np.flatnonzero(feature >= 0):
                f[first + k], t[first + k] = feature[k], cuts[feature[k]][cut[k]]
            split = feature[place] >= 0
            right = code[np.arange(len(y)), np.maximum(feature[place], 0)] > cut[place]
            node = 2 * node + 1 + (split & right)
        leaf = node - inner
        value = rate * np.bincount(leaf, g, n_leaves) / (np.bincount(leaf, h, n_leaves) + ridge)
        score += value[leaf]
        all_f.append(f)
        all_t.append(t)
        all_v.append(value)
    return Trees(bias, np.stack(all_f), np.stack(all_t), np.stack(all_v))
