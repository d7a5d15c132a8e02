"""Histogram gradient-boosted trees for a 0/1 label, flattened into arrays that numpy walks for all rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: node k of a tree has the children 2k+1 and 2k+2; leaves follow the nodes."""

    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray  # the same; rows above it go right
    leaf: np.ndarray  # (trees, 2**depth)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_forest(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
               rate: float = 0.2, ridge: float = 1.0, least: float = 2.0) -> Forest:
    """Logistic boosting on quantile bins. Ties take the lowest feature and cut, so equal input gives equal trees.

    Rows of one label only, or no rows, give a forest of that one constant (0.5 without rows).
    """
    n, wide = rows.shape
    share = float(np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    nodes, ends = 2**depth - 1, 2**depth
    if n == 0 or labels.min() == labels.max():
        return Forest(base, np.zeros((0, nodes), np.int64), np.zeros((0, nodes), np.float32), np.zeros((0, ends)))
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(wide)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(wide)], axis=1)
    total = np.full(n, base)
    grown = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = labels - p, p * (1 - p)
        feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf, np.float32)
        place = np.zeros(n, np.int64)
        for level in range(depth):
            count, first = 2**level, 2**level - 1
            best = [(1e-6, 0, bins)] * count
            for f in range(wide):
                key = place * bins + binned[:, f]
                g = np.bincount(key, gradient, count * bins).reshape(count, bins)
                h = np.bincount(key, weight, count * bins).reshape(count, bins)
                gl, hl = g.cumsum(1), h.cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + ridge) + (ga - gl)**2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < least) | (ha - hl < least)] = -1
                gain[:, len(cuts[f]):] = -1
                for k, cut in enumerate(gain.argmax(1)):
                    if gain[k, cut] > best[k][0] + 1e-9:
                        best[k] = (gain[k, cut], f, cut)
            chosen, cut = np.array([b[1] for b in best]), np.array([b[2] for b in best])
            for k, (_, f, c) in enumerate(best):
                feature[first + k] = f
                threshold[first + k] = cuts[f][c] if c < bins else np.inf
            place = 2 * place + (binned[np.arange(n), chosen[place]] > cut[place])
        leaf = rate * np.bincount(place, gradient, ends) / (np.bincount(place, weight, ends) + ridge)
        total += leaf[place]
        grown.append((feature, threshold, leaf))
    return Forest(base, *[np.stack(part) for part in zip(*grown)])
