"""Gradient-boosted trees for two classes, on arrays: a small helper of the operators that need one."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete trees of one depth; node ``i`` has children ``2i + 1`` and ``2i + 2``."""

    depth: int
    edges: list[np.ndarray] = field(default_factory=list)
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (2**self.depth - 1)]
        return out

    def chances(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def _best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, edges: list[np.ndarray], least: float) -> tuple[int, int]:
    """The feature and bin with the largest gain; a split that sends all one way if none gains."""
    best, found = 1e-9, (0, BINS)
    whole = g.sum() ** 2 / (h.sum() + 1)
    for f in range(binned.shape[1]):
        if not len(edges[f]):
            continue
        left_g = np.cumsum(np.bincount(binned[:, f], g, minlength=BINS))[:-1]
        left_h = np.cumsum(np.bincount(binned[:, f], h, minlength=BINS))[:-1]
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - whole
        gain[(left_h < least) | (right_h < least)] = 0
        k = int(np.argmax(gain[: len(edges[f])]))
        if gain[k] > best:
            best, found = gain[k], (f, k)
    return found


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, least: float = 1.0) -> Trees:
    """Trees that lower the logistic loss, by histograms of up to ``BINS`` quantiles a feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1], method="lower")) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(depth, edges, start=float(np.log(share / (1 - share))))
    margin = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for node in range(2**depth - 1):
            here = np.flatnonzero(at == node)
            right = np.zeros(len(here), bool)
            if len(here):
                f, k = _best_split(binned[here], g[here], h[here], edges, least)
                if k < len(edges[f]):
                    feature[node], cut[node] = f, edges[f][k]
                    right = binned[here, f] > k
            at[here] = 2 * node + 1 + right
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, g, minlength=2**depth) / (np.bincount(leaf, h, minlength=2**depth) + 1)
        margin += value[leaf]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(value)
    return model
