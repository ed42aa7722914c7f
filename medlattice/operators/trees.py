"""Decision trees without a depth limit, grown level by level.

Spark's own trees stop at depth 30. Here each row carries the id of its node; a level is one histogram of (node,
feature, bin), whose running sums give every split's Gini impurity, and one join that moves the rows to the children. The model is a
table of nodes, so neither rows nor nodes pass through the driver, and a level's state is a table in the shared folder.
Below a node of few rows, one task of a bounded group grows the rest with the same splits; all such nodes go in one pass.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlattice.session import written

ROOT = 1


def feature_cuts(rows: DataFrame, features_col: str = "features", max_bins: int = 64) -> DataFrame:
    """feature, cuts: ascending candidate thresholds of each feature (all distinct values but the largest, or ``max_bins`` quantiles)."""
    values = rows.select(F.posexplode(features_col).alias("feature", "v"))
    shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    found = values.groupBy("feature").agg(F.percentile_approx("v", shares, F.lit(10000)).alias("q"), F.max("v").alias("top"))
    return found.select("feature", F.filter(F.array_sort(F.array_distinct("q")), lambda c: c < F.col("top")).alias("cuts"))


_GROWN = "node long, depth int, n long, positives long, feature int, bin int, left long, right long"


def _child(node: int, side: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{node} {side}".encode(), digest_size=8).digest(), "little", signed=True)


def _grow_below(rows: pa.Table, max_depth: int | None, min_rows: int) -> pa.Table:
    """The nodes at and below the one whose (node, depth, y, bins) rows these are, by the splits of a level of :func:`grow_tree`."""
    y = rows["y"].to_numpy()
    bins = rows["bins"].combine_chunks().flatten().to_numpy().reshape(len(y), -1).astype(np.int64)
    features, wide = bins.shape[1], int(bins.max(initial=0)) + 1
    cells = bins + np.arange(features) * wide
    out, todo = [], [(rows["node"][0].as_py(), rows["depth"][0].as_py(), np.arange(len(y)))]
    while todo:
        node, depth, own = todo.pop()
        n, p = len(own), int(y[own].sum())
        leaf = (node, depth, n, p, None, None, None, None)
        if not 0 < p < n or n < min_rows or not features or (max_depth is not None and depth >= max_depth):
            out.append(leaf)
            continue
        nl = np.bincount(cells[own].ravel(), minlength=features * wide).reshape(features, wide).cumsum(1)
        pl = np.bincount(cells[own[y[own] == 1]].ravel(), minlength=features * wide).reshape(features, wide).cumsum(1)
        at = np.flatnonzero((nl > 0) & (nl < n))
        if not len(at):
            out.append(leaf)
            continue
        nl, pl = nl.ravel()[at], pl.ravel()[at]
        nr, pr = n - nl, p - pl
        # the first of least impurity: the smaller feature, then bin
        feature, cut = divmod(int(at[np.argmin(pl * (nl - pl) / nl + pr * (nr - pr) / nr)]), wide)
        goes = bins[own, feature] <= cut
        left, right = _child(node, "left"), _child(node, "right")
        out.append((node, depth, n, p, feature, cut, left, right))
        todo += [(left, depth + 1, own[goes]), (right, depth + 1, own[~goes])]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[c.split()[0] for c in _GROWN.split(", ")])


def grow_tree(rows: DataFrame, features_col: str = "features", label_col: str = "label", max_bins: int = 64,
              max_depth: int | None = None, min_rows: int = 2, few: int = 4096) -> DataFrame:
    """M3: nodes of a binary classification tree (labels 0 and 1) grown until every node is pure or cannot be split.

    -> node, depth, n, positives, feature, threshold, left, right; a leaf has no feature. A row goes left if its feature <= threshold. The split
    of least Gini impurity wins, ties by smaller feature, then threshold. ``max_depth`` None: no limit. Rows with a null label, null
    features or a null component take no part. Memory of a task follows features * bins, not rows. Nodes of at most ``few`` rows leave the
    levels, and what is below them is grown within their group in one pass at the end.
    """
    rows = rows.where(F.col(label_col).isNotNull() & F.col(features_col).isNotNull() & ~F.exists(features_col, lambda x: x.isNull()))
    cuts = written(feature_cuts(rows, features_col, max_bins), "tree-cuts")
    # One row per feature: bounded by features * bins.
    packed = cuts.agg(F.transform(F.array_sort(F.collect_list(F.struct("feature", "cuts"))), lambda x: x["cuts"])).scalar()
    state = written(rows.select(F.col(label_col).cast("long").alias("y"), F.col(features_col).alias("x"), packed.alias("cuts")).select(
        "y", F.transform("x", lambda v, f: F.size(F.filter(F.col("cuts")[f], lambda c: c < v))).alias("bins"), F.lit(ROOT).cast("long").alias("node")), "tree-rows")
    out, grouped, depth = None, None, 0

    def shown(level: DataFrame) -> DataFrame:
        """Nodes with the threshold of their bin."""
        return (level.join(cuts.withColumnRenamed("feature", "f"), F.col("feature") == F.col("f"), "left")
                .withColumn("threshold", F.when(F.col("feature").isNotNull(), F.element_at("cuts", F.col("bin") + 1)))
                .select("node", "depth", "n", "positives", "feature", "threshold", "left", "right"))

    while True:
        counts = written(state.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "tree-counts")
        small = state.join(counts.where(F.col("n") <= few), "node", "left_semi").select("node", F.lit(depth).alias("depth"), "y", "bins")
        grouped = small if grouped is None else grouped.unionByName(small)
        state = state.join(counts.where(F.col("n") > few), "node", "left_semi")
        nodes = state.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))
        open_ = (F.col("positives") > 0) & (F.col("positives") < F.col("n")) & (F.col("n") >= min_rows)
        if max_depth is not None and depth >= max_depth:
            open_ = F.lit(False)
        bins = state.select("node", "y", F.posexplode("bins").alias("feature", "bin")).groupBy("node", "feature", "bin").agg(
            F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"))
        own = Window.partitionBy("node", "feature")
        run = own.orderBy("bin")
        sums = bins.select("node", "feature", "bin", F.sum("n").over(run).alias("nl"), F.sum("p").over(run).alias("pl"),
                           F.sum("n").over(own).alias("n"), F.sum("p").over(own).alias("p")).where("nl < n")

        def gini(n, p):
            return p * (n - p) / n

        worse = gini(F.col("nl"), F.col("pl")) + gini(F.col("n") - F.col("nl"), F.col("p") - F.col("pl"))
        best = sums.groupBy("node").agg(F.min(F.struct(worse.alias("g"), "feature", "bin")).alias("best"))
        level = written(nodes.join(best, "node", "left").withColumn("best", F.when(open_, F.col("best")))
                 .select("node", F.lit(depth).alias("depth"), "n", "positives", F.col("best.feature").alias("feature"), F.col("best.bin").alias("bin"),
                         *[F.when(F.col("best").isNotNull(), F.xxhash64("node", F.lit(side))).alias(side) for side in ("left", "right")]), "tree-level")
        out = level if out is None else out.unionByName(level)
        splits = level.where(F.col("feature").isNotNull())
        if splits.isEmpty():
            below = grouped.groupBy("node").applyInArrow(lambda group: _grow_below(group, max_depth, min_rows), _GROWN)
            return shown(out.unionByName(below))
        left = F.element_at("bins", F.col("feature") + 1) <= F.col("bin")
        state = written(state.join(splits.select("node", "feature", "bin", "left", "right"), "node").select(
            "y", "bins", F.when(left, F.col("left")).otherwise(F.col("right")).alias("node")), "tree-rows")
        depth += 1


def tree_predictions(nodes: DataFrame, rows: DataFrame, key: str, features_col: str = "features", checkpoint_every: int = 8) -> DataFrame:
    """key, prediction (1 if most training rows of its leaf are), probability (their share), depth of the leaf. Rows with null features are absent."""
    levels = nodes.agg(F.max("depth")).first()[0]
    at = rows.where(F.col(features_col).isNotNull()).select(key, F.col(features_col).alias("x"), F.lit(ROOT).cast("long").alias("node"))
    out = None
    for depth in range((levels if levels is not None else -1) + 1):
        met = at.join(nodes.where(F.col("depth") == depth), "node")
        done = met.where(F.col("feature").isNull()).select(key, (2 * F.col("positives") > F.col("n")).cast("int").alias("prediction"),
                                                           (F.col("positives") / F.col("n")).alias("probability"), "depth")
        out = done if out is None else out.unionByName(done)
        at = met.where(F.col("feature").isNotNull()).select(
            key, "x", F.when(F.element_at("x", F.col("feature") + 1) <= F.col("threshold"), F.col("left")).otherwise(F.col("right")).alias("node"))
        if (depth + 1) % checkpoint_every == 0:
            at, out = written(at, "tree-at"), written(out, "tree-leaves")
    return out
