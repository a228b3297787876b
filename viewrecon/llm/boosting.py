"""Gradient-boosted trees for several classes, on binned features, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Softmax over ``classes`` sums of trees of equal depth, each grown on histograms of gradients of a random share of the rows."""

    def __init__(self, classes: int, rounds: int = 40, depth: int = 5, rate: float = 0.15, ridge: float = 2.0, least: float = 16.0, share: float = 0.3, seed: int = 5):
        self.classes, self.rounds, self.depth, self.rate, self.ridge, self.least, self.share, self.seed = classes, rounds, depth, rate, ridge, least, share, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x = np.ascontiguousarray(x)
        quantiles = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
        self.cuts = [np.unique(quantiles[:, f]) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(self.cuts)], axis=1).astype(np.int64)
        n, width = binned.shape
        self.prior = np.log((np.bincount(y, minlength=self.classes) + 1) / (n + self.classes))
        total = np.tile(self.prior, (n, 1))
        onehot = np.eye(self.classes)[y]
        inner, leaves = 2**self.depth - 1, 2**self.depth
        self.feature = np.zeros((self.rounds, self.classes, inner), np.int32)
        self.cut = np.full((self.rounds, self.classes, inner), np.inf)
        self.value = np.zeros((self.rounds, self.classes, leaves))
        rng = np.random.default_rng(self.seed)
        for r in range(self.rounds):
            p = np.exp(total - total.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            rows = np.sort(rng.permutation(n)[: max(1, round(n * self.share))])
            some = binned[rows]
            flat = some + np.arange(width) * BINS
            for c in range(self.classes):
                g, h = p[rows, c] - onehot[rows, c], p[rows, c] * (1 - p[rows, c])
                node = np.zeros(len(rows), np.int64)
                for level in range(self.depth):
                    nodes = 2**level
                    index = (node[:, None] * (width * BINS) + flat).ravel()
                    size = nodes * width * BINS
                    gs = np.bincount(index, np.repeat(g, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
                    hs = np.bincount(index, np.repeat(h, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
                    gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                    gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(hs < self.least / 4) | (ht - hs < self.least / 4)] = 0
                    best = gain.reshape(nodes, -1).argmax(axis=1)
                    goes = np.zeros(len(rows), bool)
                    for k in range(nodes):
                        f, b = divmod(int(best[k]), BINS)
                        if gain[k, f, b] > 1e-9 and b < len(self.cuts[f]):
                            self.feature[r, c, nodes - 1 + k], self.cut[r, c, nodes - 1 + k] = f, self.cuts[f][b]
                            goes |= (node == k) & (some[:, f] > b)
                    node = 2 * node + goes
                gl, hl = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
                self.value[r, c] = -self.rate * gl / (hl + self.ridge)
            for c in range(self.classes):
                total[:, c] += self.value[r, c][self._leaf(r, c, x)]
        return self

    def _leaf(self, r: int, c: int, x: np.ndarray) -> np.ndarray:
        """The leaf of tree (r, c) that each row comes to. x: in C order."""
        flat, begins = x.ravel(), np.arange(len(x)) * x.shape[1]
        feature, cut = self.feature[r, c], self.cut[r, c]
        node = np.zeros(len(x), np.int64)
        for level in range(self.depth):
            at = node + (2**level - 1)
            node = 2 * node + (flat.take(begins + feature.take(at)) > cut.take(at))
        return node

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(x)
        total = np.tile(self.prior, (len(x), 1))
        for r in range(self.rounds):
            for c in range(self.classes):
                total[:, c] += self.value[r, c].take(self._leaf(r, c, x))
        total -= total.max(axis=1, keepdims=True)
        return total - np.log(np.exp(total).sum(axis=1, keepdims=True))
