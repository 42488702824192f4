"""Small gradient-boosted trees (logistic loss) for candidate scoring in tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Depth-limited regression trees on the logistic loss, Newton leaf values."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    min_rows: int = 5
    trees: list = field(default_factory=list)
    base: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.05, 0.95, 19))) for j in range(x.shape[1])]
        bins = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)])
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(bins, y - p, p * (1 - p), np.arange(len(y)), cuts, self.depth)
            self.trees.append(tree)
            f = f + self._apply(tree, x)
        return self

    def _grow(self, bins, g, h, rows, cuts, depth):
        """A leaf value, or (feature, cut, rows up to the cut, the others)."""
        own_g, own_h = g[rows], h[rows]
        total_g, total_h = own_g.sum(), own_h.sum() + 1.0
        best = (1e-6, None)
        for j, edges in enumerate(cuts if depth and len(rows) >= 2 * self.min_rows else ()):
            at, size = bins[j, rows], len(edges) + 1
            n = np.cumsum(np.bincount(at, minlength=size))[:-1]
            gl = np.cumsum(np.bincount(at, own_g, size))[:-1]
            hl = np.cumsum(np.bincount(at, own_h, size))[:-1] + 1.0
            gain = gl * gl / hl + (total_g - gl) ** 2 / (total_h - hl + 1.0) - total_g ** 2 / total_h
            gain[(n < self.min_rows) | (len(rows) - n < self.min_rows)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), (j, int(gain.argmax())))
        if best[1] is None:
            return float(self.rate * total_g / total_h)
        j, c = best[1]
        left = bins[j, rows] <= c
        return (j, float(cuts[j][c]), self._grow(bins, g, h, rows[left], cuts, depth - 1),
                self._grow(bins, g, h, rows[~left], cuts, depth - 1))

    def fit_cells(self, parts, cuts: list[np.ndarray], share: float) -> "BoostedTrees":
        """Grow the trees level by level from sums over all rows.

        ``parts(sums)`` applies ``sums(bins, y, weight)`` to every part of the rows and
        gives the results; parts may lie in different tasks, as only sums by node,
        feature and bin leave them.  ``bins`` has a row for each of ``cuts``."""
        share = min(max(share, 1e-3), 1 - 1e-3)
        self.base, self.trees, grown = float(np.log(share / (1 - share))), [], []
        sizes = [len(c) + 1 for c in cuts]
        for _ in range(self.rounds):
            tree, level = [None], [[]]
            for depth in range(self.depth, -1, -1):
                total = sum(parts(_level_sums(self.base, grown, tree[0], level, sizes)))
                below = []
                for path, node in zip(level, total):
                    split = self._best_split(node, sizes) if depth else None
                    rows, g, h = node[:, :sizes[0]].sum(1)
                    _put(tree, path, float(self.rate * g / (h + 1.0)) if split is None else [*split, None, None])
                    below += [[*path, 2], [*path, 3]] if split else []
                level = below
                if not level:
                    break
            grown.append(tree[0])
            self.trees.append(_with_cuts(tree[0], cuts))
        return self

    def _best_split(self, node, sizes):
        """(feature, last bin of the lower side) of the largest gain, the first of equal
        ones, or None; ``node`` has rows, gradient and curvature by feature and bin.
        Sums of parts differ in their last bits, so nearly equal gains are equal."""
        best, at = (1e-6, None), 0
        rows, total_g, total_h = node[:, :sizes[0]].sum(1)
        for j, size in enumerate(sizes if rows >= 2 * self.min_rows else ()):
            n, gl, hl = np.cumsum(node[:, at:at + size], 1)[:, :-1]
            gain = gl * gl / (hl + 1.0) + (total_g - gl) ** 2 / (total_h - hl + 1.0) - total_g ** 2 / (total_h + 1.0)
            gain[(n < self.min_rows) | (rows - n < self.min_rows)] = 0
            if len(gain) and gain.max() > best[0] * (1 + 1e-9):
                best = (gain.max(), (j, int((gain >= gain.max() * (1 - 1e-9)).argmax())))
            at += size
        return best[1]

    def _apply(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, c, lo, hi = tree
        return np.where(x[:, j] <= c, self._apply(lo, x), self._apply(hi, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        f = np.full(len(x), self.base)
        for tree in self.trees:
            f += self._apply(tree, x)
        return 1 / (1 + np.exp(-f))


def _put(tree: list, path: list[int], value) -> None:
    at, steps = tree, [0, *path]
    for i in steps[:-1]:
        at = at[i]
    at[steps[-1]] = value


def _with_cuts(node, cuts):
    if not isinstance(node, list):
        return node
    j, c, lo, hi = node
    return (j, float(cuts[j][c]), _with_cuts(lo, cuts), _with_cuts(hi, cuts))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every value; a row for each feature."""
    return np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)


def _level_sums(base: float, grown: list, tree, level: list, sizes: list[int]):
    """Function from rows (bins, y, weight) to their number, gradient and curvature
    by node of ``level``, feature and bin, under the trees ``grown`` so far."""
    def value(node, bins, rows, out):
        if isinstance(node, list):
            low = bins[node[0], rows] <= node[1]
            value(node[2], bins, rows[low], out)
            value(node[3], bins, rows[~low], out)
        else:
            out[rows] += node

    def reached(node, path, bins, rows):
        for step in path:
            low = bins[node[0], rows] <= node[1]
            rows, node = rows[low if step == 2 else ~low], node[step]
        return rows

    def sums(bins, y, weight):
        every, f = np.arange(len(y)), np.full(len(y), base)
        for done in grown:
            value(done, bins, every, f)
        p = 1 / (1 + np.exp(-f))
        per_row = (weight, weight * (y - p), weight * p * (1 - p))
        out = np.zeros((len(level), 3, sum(sizes)))
        for k, path in enumerate(level):
            rows, at = reached(tree, path, bins, every), 0
            for j, size in enumerate(sizes):
                for s, w in enumerate(per_row):
                    out[k, s, at:at + size] = np.bincount(bins[j, rows], w[rows], size)
                at += size
        return out

    return sums


def weighted_cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The 19 inner twentieths of sorted ``values`` that occur ``counts`` times, each once."""
    upto = np.cumsum(counts)
    at = np.linspace(0.05, 0.95, 19) * (upto[-1] - 1)
    low, high = (values[np.searchsorted(upto, f(at), "right")] for f in (np.floor, np.ceil))
    return np.unique(low + (high - low) * (at - np.floor(at)))


def calibrated_threshold(p: np.ndarray, y: np.ndarray, precision: float, weight: np.ndarray | None = None) -> float:
    """The lowest score from which on, at every higher one too, the share of
    class 1 among the rows at or above it is at least ``precision``; 2.0 (no
    row) if there is none.  ``weight`` is the number of rows of each entry."""
    order = np.argsort(-p, kind="stable")
    w = np.ones(len(y)) if weight is None else weight[order]
    share = np.cumsum(y[order] * w) / np.cumsum(w)
    ends = np.append(np.flatnonzero(np.diff(p[order])), len(p) - 1) if len(p) else np.array([], int)
    good = ends[np.minimum.accumulate(share[ends] >= precision)] if len(ends) else ends
    return float(p[order][good[-1]]) if len(good) else 2.0
