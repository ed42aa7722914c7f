"""A small gradient-boosted classifier, fitted on bounded training samples or on all rows of a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import map_arrow, settle

# Weights and sums of fit_folds are integers, so that they do not depend on how rows are dealt; ONE is the weight 1.
ONE = 1 << 32
_WIDTH = 32  # bins of a feature
_ROWS, _MOST_TASKS, _KEPT = 20_000, 64, 8


class BoostedTrees:
    """Logistic loss, complete trees of ``depth`` levels, histogram splits."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.base = 0.0
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, edges: list[np.ndarray] | None = None) -> BoostedTrees:
        mean = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
        self.base = float(np.log(mean / (1 - mean)))
        if not len(y):
            return self
        if edges is None:
            edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        places = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            features, cuts = [], []
            for level in range(self.depth):
                n = 1 << level
                best = np.zeros(n)
                feature, cut = np.zeros(n, np.int64), np.full(n, np.inf)
                for j, e in enumerate(edges):
                    w = len(e) + 1
                    if w < 2:
                        continue
                    at = node * w + places[:, j]
                    g = np.bincount(at, grad, n * w).reshape(n, w).cumsum(axis=1)
                    h = np.bincount(at, hess, n * w).reshape(n, w).cumsum(axis=1)
                    gl, hl, ga, ha = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    gain = gl ** 2 / (hl + self.ridge) + (ga - gl) ** 2 / (ha - hl + self.ridge) - ga ** 2 / (ha + self.ridge)
                    k = gain.argmax(axis=1)
                    better = gain[np.arange(n), k] > best + 1e-9
                    best[better] = gain[np.arange(n), k][better]
                    feature[better], cut[better] = j, e[k[better]]
                features.append(feature)
                cuts.append(cut)
                node = node * 2 + (x[np.arange(len(y)), feature[node]] > cut[node])
            leaves = -np.bincount(node, grad, 1 << self.depth) / (np.bincount(node, hess, 1 << self.depth) + self.ridge) * self.rate
            self.splits.append((np.concatenate(features), np.concatenate(cuts), leaves))
            score = score + leaves[node]
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, cuts, leaves in self.splits:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = node * 2 + (x[rows, features[at]] > cuts[at])
            score += leaves[node]
        return 1 / (1 + np.exp(-score))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """For each row and feature, how many of the feature's edges are below."""
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


def _leaves(bins: np.ndarray, features: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for level in range(levels):
        at = (1 << level) - 1 + node
        node = node * 2 + (bins[rows, features[at]] > cuts[at])
    return node


def fit_folds(rows: DataFrame, edges: list[np.ndarray], folds: int, trees: int = 40, depth: int = 3, rate: float = 0.2,
              ridge: float = 1.0) -> list[BoostedTrees]:
    """For each fold trees fitted on all rows of the other folds, and last trees fitted on all rows.

    ``rows``: bins binary (:func:`binned`, at most 32 a feature), fold int, y int (0 or 1), weight long (in units of ``ONE``; 2**53 in all at most). One
    job a level for all fits: each task sums gradients by node, feature and bin over its rows, and the driver adds the sums of
    at most 64 tasks. Scores of the trees so far are written with the rows every few trees.
    """
    fits, wide, limits = folds + 1, len(edges), np.array([len(e) for e in edges])
    base = np.zeros(fits)
    total = rows.groupBy("fold").agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("y")).alias("p")).collect()
    for m in range(fits):
        own = [r for r in total if r.fold != m]
        mean = np.clip(sum(r.p for r in own) / max(1, sum(r.w for r in own)), 1e-4, 1 - 1e-4)
        base[m] = np.log(mean / (1 - mean))
    spread = min(_MOST_TASKS, 1 + rows.count() // _ROWS)
    grown: list[list] = [[] for _ in range(fits)]

    def scores(batch: pa.RecordBatch, bins: np.ndarray, kept: int, grown: list) -> np.ndarray:
        out = np.frombuffer(b"".join(batch.column(4).to_pylist()), float).reshape(-1, fits).copy() if kept else np.tile(base, (len(bins), 1))
        for m in range(fits):
            for features, cuts, leaves in grown[m][kept:]:
                out[:, m] += leaves[_leaves(bins, features, cuts, depth)]
        return out

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, wide)

    def add(table: DataFrame, kept: int, grown: list, level: int, started: list) -> tuple[np.ndarray, np.ndarray]:
        shape = (fits, 1 << level, wide, _WIDTH)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g, h = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                bins = matrix(batch)
                fold, y, weight = (batch.column(i).to_numpy() for i in (1, 2, 3))
                p = 1 / (1 + np.exp(-scores(batch, bins, kept, grown)))
                cell = np.arange(wide) * _WIDTH + bins
                for m in range(fits):
                    use = fold != m
                    node = _leaves(bins[use], *started[m], level)
                    at = (node[:, None] * (wide * _WIDTH) + cell[use]).ravel()
                    q, w = p[use, m], weight[use]
                    for out, value in ((g, (q - y[use]) * w), (h, q * (1 - q) * w)):
                        out[m] += np.bincount(at, np.repeat(np.rint(value), wide), out[m].size).astype(np.int64).reshape(shape[1:])
            yield pa.RecordBatch.from_arrays([pa.array([g.tobytes()]), pa.array([h.tobytes()])], names=["g", "h"])

        parts = map_arrow(table.coalesce(spread), run, "g binary, h binary").collect()
        return tuple(sum(np.frombuffer(r[i], np.int64) for r in parts).reshape(shape) / ONE for i in (0, 1))

    def advance(table: DataFrame, kept: int, grown: list) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    new = [x.tobytes() for x in scores(batch, matrix(batch), kept, grown)]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(new, pa.binary())], names=["bins", "fold", "y", "weight", "score"])

        return settle(map_arrow(table.coalesce(spread), run, "bins binary, fold int, y int, weight long, score binary"), "scores")

    table, kept = rows.select("bins", "fold", "y", "weight"), 0
    for done in range(trees):
        if done - kept == _KEPT:
            table, kept = advance(table, kept, grown), done
        started = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(fits)]
        for level in range(depth):
            sums = add(table, kept, grown, level, started)
            for m in range(fits):
                g, h = (x[m].cumsum(axis=2) for x in sums)
                gl, hl, ga, ha = g[:, :, :-1], h[:, :, :-1], g[:, :, -1:], h[:, :, -1:]
                gain = (gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge)).reshape(1 << level, -1)
                best, nodes = gain.argmax(axis=1), np.arange(1 << level)
                feature, cut = np.divmod(best, _WIDTH - 1)
                split = (gain[nodes, best] > 1e-9) & (cut < limits[feature])
                feature, cut = np.where(split, feature, 0), np.where(split, cut, 255)
                started[m] = (np.append(started[m][0], feature), np.append(started[m][1], cut))
                if level == depth - 1:
                    at = np.minimum(cut, _WIDTH - 1)
                    left = g[nodes, feature, at], h[nodes, feature, at]
                    both = [np.stack([x, whole[nodes, feature, -1] - x], axis=1).ravel() for x, whole in zip(left, (g, h))]
                    grown[m].append((*started[m], -both[0] / (both[1] + ridge) * rate))
    out = []
    for m in range(fits):
        model = BoostedTrees(trees, depth, rate, _WIDTH, ridge)
        model.base = float(base[m])
        model.splits = [(f, np.array([edges[j][c] if c < 255 else np.inf for j, c in zip(f, cuts)]), leaves) for f, cuts, leaves in grown[m]]
        out.append(model)
    return out
