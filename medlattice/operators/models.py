"""Model jobs on pyspark.ml plus the two custom learners of the original:
bagged SGD logistic regression (one weight vector per model, trained
inside a task with ``mapInPandas``) and the streaming k-means update.

Hyper-parameters default to the original's values (fixed values):
logistic regression C=1, decision tree depth 5, k-means k=3 / 20
iterations / seed 6205, streaming k-means decay 1.0 / weight 0.5 / seed
6250, MLP hidden layer 64, PCA 10 components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice.functions.scalars import sigmoid, stable_uniform
from medlattice.operators import metrics

KMEANS_SEED = 6205
STREAM_SEED = 6250
BAG_SEED = 6505


# ------------------------------------------------------------ classifiers

def logistic_regression(train: DataFrame, c: float = 1.0, n_rows: int | None = None, max_iter: int = 100):
    """M1: L2 logistic regression. sklearn's C maps to regParam = 1/(C·n)
    (Spark averages the loss over rows); no standardization."""
    from pyspark.ml.classification import LogisticRegression

    n = n_rows or train.count()
    return LogisticRegression(regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False,
                              maxIter=max_iter, featuresCol="features", labelCol="label").fit(train)


def linear_svm(train: DataFrame, c: float = 1.0, n_rows: int | None = None, max_iter: int = 100):
    """M2: linear SVM (hinge loss) with the same regularization mapping."""
    from pyspark.ml.classification import LinearSVC

    n = n_rows or train.count()
    return LinearSVC(regParam=1.0 / (c * max(n, 1)), standardization=False, maxIter=max_iter,
                     featuresCol="features", labelCol="label").fit(train)


def decision_tree(train: DataFrame, max_depth: int = 5, seed: int = 0):
    """M3: decision tree (depth 5). Spark's own trees have at most 30 levels; ``trees.grow_tree`` has no limit."""
    from pyspark.ml.classification import DecisionTreeClassifier

    if max_depth > 30:
        raise ValueError("at most 30 levels here; use trees.grow_tree for deeper trees")
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed,
                                  featuresCol="features", labelCol="label").fit(train)


def positive_probability(predictions: DataFrame, col: str = "probability") -> F.Column:
    """probability of class 1 from an ML probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(col))[1]


def predictions_frame(model, data: DataFrame, key: str = "patient_id") -> DataFrame:
    """Key, label, prediction, probability of class 1 (or raw margin)."""
    out = model.transform(data)
    if "probability" in out.columns:
        score = positive_probability(out)
    else:
        from pyspark.ml.functions import vector_to_array

        score = vector_to_array(F.col("rawPrediction"))[1]
    return out.select(key, F.col("label").cast("int").alias("label"),
                      F.col("prediction").cast("int").alias("prediction"), score.alias("score"))


def classifier_report(preds_by_model: dict[str, DataFrame]) -> DataFrame:
    """M4: one row of binary metrics per model."""
    frames = [metrics.binary_metrics(p, "label", "prediction", "score").withColumn("model", F.lit(name))
              for name, p in preds_by_model.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def add_folds(df: DataFrame, k: int = 5, seed: int = BAG_SEED, key: str = "patient_id") -> DataFrame:
    """M5: stable fold number 0..k-1 from a hash of the id."""
    return df.withColumn("fold", F.floor(stable_uniform(key, seed) * k).cast("int"))


def kfold_scores(data: DataFrame, fit, k: int = 5, seed: int = BAG_SEED, key: str = "patient_id") -> DataFrame:
    """M5: per-fold accuracy and AUC of ``fit`` (train -> model), plus the
    rounded means (A24). Folds run one after another; each fit is distributed."""
    f = add_folds(data, k, seed, key).persist()
    rows = []
    for i in range(k):
        model = fit(f.where(F.col("fold") != i))
        p = predictions_frame(model, f.where(F.col("fold") == i), key)
        rows.append(metrics.binary_metrics(p, "label", "prediction", "score")
                    .select(F.lit(i).alias("fold"), "accuracy", "auc"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    out = out.persist()
    out.count()
    f.unpersist()
    return out


def random_splits(df: DataFrame, rounds: int = 5, test_share: float = 0.2, seed: int = BAG_SEED,
                  key: str = "patient_id") -> DataFrame:
    """M6: for each round, a hashed test/train assignment per row (one
    independent stream per round)."""
    r = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
    u = stable_uniform(key, seed, F.col("round"))
    return r.withColumn("split", F.when(u < test_share, F.lit("test")).otherwise(F.lit("train")))


def randomized_cv_scores(data: DataFrame, fit, rounds: int = 5, test_share: float = 0.2,
                         seed: int = BAG_SEED, key: str = "patient_id") -> DataFrame:
    """M6: accuracy and AUC per round of repeated random 80/20 splits."""
    s = random_splits(data, rounds, test_share, seed, key).persist()
    rows = []
    for i in range(rounds):
        cur = s.where(F.col("round") == i)
        model = fit(cur.where(F.col("split") == "train"))
        p = predictions_frame(model, cur.where(F.col("split") == "test"), key)
        rows.append(metrics.binary_metrics(p, "label", "prediction", "score")
                    .select(F.lit(i).alias("round"), "accuracy", "auc"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    out = out.persist()
    out.count()
    s.unpersist()
    return out


# ------------------------------------------------- bagged SGD ensemble

def bagging_fanout(samples: DataFrame, n_models: int, ratio: float, seed: int = BAG_SEED,
                   key: str = "patient_id") -> DataFrame:
    """Each sample independently joins each of n models with
    probability ``ratio`` (hash of (id, model), not a shared RNG)."""
    fan = samples.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_models))).alias("model_id"))
    return fan.where(stable_uniform(key, seed, F.col("model_id")) < ratio)


_SHARD_WEIGHTS = T.StructType([T.StructField("model_id", T.IntegerType()),
                               T.StructField("_ns", T.IntegerType()),
                               T.StructField("idx", T.IntegerType()),
                               T.StructField("weight", T.DoubleType())])

# Rows one SGD task streams at most; a model's bag beyond this is split.
SGD_ROWS_PER_SHARD = 2_000_000


def _sgd_partition(eta: float, mu: float, n_feature: int):
    """Stream one partition (sorted by model, shard, then sample order)
    through SGD, one weight vector per (model, shard); emit its non-zero
    weights when the shard's rows end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, n_shards, w = None, None, None

        def flush(key, ns, weights):
            nz = np.nonzero(weights)[0]
            return pd.DataFrame({"model_id": np.full(len(nz), key[0], dtype=np.int32),
                                 "_ns": np.full(len(nz), ns, dtype=np.int32),
                                 "idx": nz.astype(np.int32), "weight": weights[nz]})

        for pdf in batches:
            for model_id, shard, ns, label, idxs, vals in zip(pdf["model_id"], pdf["_shard"], pdf["_ns"],
                                                              pdf["label"], pdf["idx"], pdf["val"]):
                if (model_id, shard) != current:
                    if current is not None:
                        yield flush(current, n_shards, w)
                    current, n_shards, w = (model_id, shard), ns, np.zeros(n_feature)
                idxs = np.asarray(idxs, dtype=np.int64)
                vals = np.asarray(vals, dtype=np.float64)
                margin = float(np.dot(w[idxs], vals))
                for f, v in zip(idxs, vals):
                    # probability recomputed after every coordinate update,
                    # kept O(nnz) by updating the margin incrementally
                    p = 1.0 / (1.0 + np.exp(-margin))
                    step = eta * ((p - label) * v + 2.0 * mu * w[f])
                    w[f] -= step
                    margin -= step * v
        if current is not None:
            yield flush(current, n_shards, w)

    return run


def train_sgd_ensemble(bagged: DataFrame, n_feature: int, eta: float = 0.01, mu: float = 0.0,
                       order: str = "patient_id", rows_per_shard: int = SGD_ROWS_PER_SHARD) -> DataFrame:
    """M8: one L2 SGD logistic regression per model_id.

    bagged: model_id, label, pairs (array<struct<idx, value>>), <order>.
    A model's bag of r rows is split into ceil(r / rows_per_shard) shards
    by a hash of the order key; rows are hash-partitioned by (model, shard)
    and sorted by (model, shard, order) inside each partition, and a task
    streams its rows holding one weight vector at a time. Each shard runs
    the sequential SGD pass; a model's weights are the mean over its
    shards (parallelized SGD with parameter averaging, Zinkevich et al.
    2010). A bag within one shard gives exactly the sequential result.
    -> model_id, idx, weight (non-zero weights only).
    """
    per_model = bagged.groupBy(F.col("model_id").cast("int").alias("model_id")).agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(rows_per_shard))).cast("int").alias("_ns"))
    prepared = (bagged.select(F.col("model_id").cast("int").alias("model_id"),
                              F.col("label").cast("double").alias("label"),
                              F.col("pairs.idx").alias("idx"), F.col("pairs.value").alias("val"),
                              F.col(order).alias("_ord"))
                # one row per model: bounded by the ensemble size
                .join(F.broadcast(per_model), "model_id")
                .withColumn("_shard", F.pmod(F.xxhash64("_ord"), F.col("_ns")).cast("int"))
                .repartition("model_id", "_shard").sortWithinPartitions("model_id", "_shard", "_ord")
                .drop("_ord"))
    shard_weights = prepared.mapInPandas(_sgd_partition(eta, mu, n_feature), _SHARD_WEIGHTS)
    return (shard_weights.groupBy("model_id", "idx")
            .agg((F.sum("weight") / F.first("_ns")).alias("weight"))
            .where(F.col("weight") != 0.0))


def ensemble_probability(weights: DataFrame, samples: DataFrame, key: str = "patient_id") -> DataFrame:
    """Mean over the M models of sigmoid(Σ w·x). samples: key, pairs.

    Features are exploded and equi-joined to the weights on idx; each
    (sample, model) margin is a grouped sum. A model with no weight on any
    of the sample's features has margin 0, i.e. probability 1/2, so
    mean = (Σ_models-with-margin sigmoid(m) + (M - k)/2) / M: no cross
    product of samples and models is ever built. M is a one-row aggregate.
    """
    x = samples.select(key, F.explode("pairs").alias("p")).select(key, F.col("p.idx").alias("idx"),
                                                                  F.col("p.value").alias("value"))
    n_models = weights.agg(F.countDistinct("model_id").alias("_M"))
    margins = (x.join(weights, "idx").groupBy(key, "model_id")
               .agg(F.sum(F.col("weight") * F.col("value")).alias("margin")))
    per_sample = margins.groupBy(key).agg(F.sum(sigmoid("margin")).alias("_s"), F.count(F.lit(1)).alias("_k"))
    full = metrics.attach_row(samples.select(key).distinct().join(per_sample, key, "left"), n_models)
    s = F.coalesce(F.col("_s"), F.lit(0.0))
    k = F.coalesce(F.col("_k"), F.lit(0))
    return full.select(key, ((s + (F.col("_M") - k) * 0.5) / F.col("_M")).alias("probability"))


# ------------------------------------------------------- unsupervised

def standardize(df: DataFrame, input_col: str = "features", output_col: str = "scaled"):
    """Zero mean, unit sample std; constant columns give 0."""
    from pyspark.ml.feature import StandardScaler

    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True).fit(df)


def pca(df: DataFrame, k: int = 10, input_col: str = "scaled", output_col: str = "pca"):
    """Principal components (the d x d covariance is built on the driver:
    keep d moderate, e.g. candidate features)."""
    from pyspark.ml.feature import PCA

    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df)


def kmeans(df: DataFrame, k: int = 3, max_iter: int = 20, seed: int = KMEANS_SEED, input_col: str = "pca"):
    """K-means (k-means|| init)."""
    from pyspark.ml.clustering import KMeans

    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=input_col, predictionCol="cluster").fit(df)


def gaussian_mixture(df: DataFrame, k: int = 3, max_iter: int = 20, seed: int = KMEANS_SEED,
                     input_col: str = "pca"):
    """Gaussian mixture with the same settings."""
    from pyspark.ml.clustering import GaussianMixture

    return GaussianMixture(k=k, maxIter=max_iter, seed=seed, featuresCol=input_col,
                           predictionCol="cluster").fit(df)


def clustering_pipeline(k: int = 3, pca_k: int = 10, model: str = "kmeans", input_col: str = "features"):
    """Scale -> PCA -> clusterer as one ML Pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import GaussianMixture, KMeans
    from pyspark.ml.feature import PCA, StandardScaler

    stages = [StandardScaler(inputCol=input_col, outputCol="scaled", withMean=True, withStd=True),
              PCA(k=pca_k, inputCol="scaled", outputCol="pca")]
    if model == "kmeans":
        stages.append(KMeans(k=k, maxIter=20, seed=KMEANS_SEED, featuresCol="pca", predictionCol="cluster"))
    else:
        stages.append(GaussianMixture(k=k, maxIter=20, seed=KMEANS_SEED, featuresCol="pca",
                                      predictionCol="cluster"))
    return Pipeline(stages=stages)


def random_centers(spark, k: int, dim: int, weight: float = 0.5, seed: int = STREAM_SEED) -> DataFrame:
    """Initial streaming centers: k Gaussian random points of size ``dim``
    with a common weight (a k-row table)."""
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.standard_normal(dim)], float(weight)) for i in range(k)]
    return spark.createDataFrame(rows, "cluster int, center array<double>, weight double")


def nearest_center(points: DataFrame, centers: DataFrame, point_col: str = "x") -> DataFrame:
    """``points`` with ``cluster``, that of the nearest center (ties: the lowest). The table of centers (cluster, center), one row
    for each, reaches every task as one scalar subquery value."""
    packed = centers.agg(F.array_sort(F.collect_list(F.struct("cluster", "center")))).scalar()
    dists = F.transform("_cs", lambda c: F.struct(
        F.aggregate(F.zip_with(F.col(point_col), c["center"], lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                    lambda acc, v: acc + v).alias("d"), c["cluster"].alias("cluster")))
    return points.withColumn("_cs", packed).withColumn("cluster", F.array_min(dists)["cluster"]).drop("_cs")


# A cluster whose weight is below this share of the largest one's is dying (fixed value).
DYING = 1e-8
# How far the halves of a split center move, relative to a component of at least 1 (fixed value).
SPLIT_STEP = 1e-14


def streaming_kmeans_update(centers: DataFrame, points: DataFrame, decay: float = 1.0,
                            point_col: str = "x", unit: str = "batches") -> DataFrame:
    """One mini-batch update of streaming k-means.

    Each point goes to its nearest center (ties: lowest cluster id); per cluster c' = (c·n·a + Σx) / (n·a + m),
    n' = n·a + m with m the points assigned and a the discount: ``decay`` per batch, or with unit "points" ``decay`` to the power of
    the batch's number of points. Clusters without points keep c. If the lightest cluster then has less than DYING of the heaviest one's weight, it
    dies: both share their weight, and take the heaviest one's center, moved apart by SPLIT_STEP. centers: cluster, center (array<double>), weight. Sums
    are vectors added map-side, so a task sends one row per cluster.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    if unit not in ("batches", "points"):
        raise ValueError("unit must be batches or points")
    pts = points.select(F.col(point_col).cast("array<double>").alias("x"))
    sums = nearest_center(pts, centers).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("m"), vector_to_array(Summarizer.sum(array_to_vector("x"))).alias("s"))
    stats = centers.select("cluster", "center", "weight").join(sums, "cluster", "left").fillna(0, ["m"])
    clusters = Window.partitionBy(F.lit(0))  # one row per cluster
    upd = stats.withColumn("points", F.sum("m").over(clusters))
    discount = F.lit(float(decay)) if unit == "batches" else F.pow(F.lit(float(decay)), F.col("points"))
    # Names of their own: inside a lambda, a name that the same select assigns would mean the new column.
    upd = upd.withColumn("_old", F.col("weight") * discount).withColumn("_new", F.col("_old") + F.col("m"))
    moved = F.zip_with("center", "s", lambda c, v: (c * F.col("_old") + v) / F.col("_new"))
    upd = upd.select("cluster", F.col("_new").alias("weight"), F.when(F.col("m") > 0, moved).otherwise(F.col("center")).alias("center"))
    upd = (upd.withColumn("_top", F.max(F.struct("weight", (-F.col("cluster")).alias("cluster"), "center")).over(clusters))
           .withColumn("_low", F.min(F.struct("weight", "cluster")).over(clusters)))
    dies = F.col("_low.weight") < F.lit(DYING) * F.col("_top.weight")
    largest, smallest = F.col("cluster") == -F.col("_top.cluster"), F.col("cluster") == F.col("_low.cluster")

    def half(sign):
        return F.transform("_top.center", lambda x: x + F.lit(sign * SPLIT_STEP) * F.greatest(F.abs(x), F.lit(1.0)))

    center = F.when(dies & largest, half(1.0)).when(dies & smallest, half(-1.0)).otherwise(F.col("center"))
    weight = F.when(dies & (largest | smallest), (F.col("_top.weight") + F.col("_low.weight")) / 2).otherwise(F.col("weight"))
    return upd.select("cluster", weight.alias("_w"), center.alias("_c")).toDF("cluster", "weight", "center")


# ------------------------------------------------------------- networks

def mlp_best(train: DataFrame, valid: DataFrame, n_inputs: int, n_classes: int, hidden: int = 64,
             iterations: tuple[int, ...] = (25, 50, 100), seed: int = 0):
    """Multilayer perceptron [d, 64, c], keeping the fit with the best
    validation accuracy over a grid of iteration counts. Returns
    (model, validation accuracy)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    best, best_acc = None, -1.0
    for it in iterations:
        m = MultilayerPerceptronClassifier(layers=[n_inputs, hidden, n_classes], maxIter=it, seed=seed,
                                           featuresCol="features", labelCol="label").fit(train)
        acc = metrics.multiclass_accuracy(m.transform(valid)).first()["accuracy_pct"]
        if acc > best_acc:
            best, best_acc = m, acc
    return best, best_acc
