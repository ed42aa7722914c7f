"""Evaluation metrics as aggregates: purity, confusion matrix, binary
metrics with ROC AUC and average precision, fold means, accuracy.

Everything is a groupBy/agg; curve statistics use distributed running
sums over distinct scores, so no score list is collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlattice.operators.indexing import running_totals


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row of ``df``.

    The aggregate becomes one uncorrelated scalar subquery (a struct of its
    columns): Spark computes it once and inlines the value, so there is no
    join and nothing sized by the data is broadcast.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in one_row.columns])


def purity(assignments: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """(1/N) Σ_k max_j |cluster k ∩ class j| -> one row (purity, n)."""
    counts = assignments.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(cluster).agg(F.max("_n").alias("_best"), F.sum("_n").alias("_size"))
    return best.agg((F.sum("_best") / F.sum("_size")).alias("purity"), F.sum("_size").alias("n"))


def confusion_matrix(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts per (truth, prediction) and the share of the truth row
    (each cell divided by its own row sum)."""
    cells = df.groupBy(F.col(truth).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    row = Window.partitionBy("truth")  # one row per class pair: tiny
    return cells.withColumn("fraction", F.col("n") / F.sum("n").over(row))


def _score_table(df: DataFrame, truth: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(truth).cast("long")).alias("pos"),
        F.sum((1 - F.col(truth).cast("long"))).alias("neg"))


def roc_auc(df: DataFrame, truth: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve (ties count one half) -> one row (auc)."""
    t = _score_table(df, truth, score)
    below = running_totals(t, "score", ["neg"], inclusive=False)
    return below.agg(
        (F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg")))
         / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def roc_curve(df: DataFrame, truth: str = "label", score: str = "score") -> DataFrame:
    """ROC points per distinct threshold (descending): threshold, fpr, tpr."""
    t = _score_table(df, truth, score)
    c = running_totals(t, "score", ["pos", "neg"], descending=True)
    tot = t.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    return attach_row(c, tot).select(
        F.col("score").alias("threshold"),
        (F.col("cum_neg") / F.col("_N")).alias("fpr"),
        (F.col("cum_pos") / F.col("_P")).alias("tpr"))


def average_precision(df: DataFrame, truth: str = "label", score: str = "score") -> DataFrame:
    """Average precision: Σ over thresholds of Δrecall × precision -> one row."""
    t = _score_table(df, truth, score)
    c = running_totals(t, "score", ["pos", "neg"], descending=True)
    return c.agg((F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
                  / F.sum("pos")).alias("average_precision"))


def binary_metrics(df: DataFrame, truth: str = "label", prediction: str = "prediction",
                   score: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, f1 from 0/1 predictions, plus AUC
    and average precision of ``score`` (the prediction when no score).
    Passing truth and prediction swapped reproduces the original report."""
    y = F.col(truth).cast("long")
    p = F.col(prediction).cast("long")
    counts = df.agg(
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).alias("tn"))
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    base = counts.select(
        (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
        F.coalesce(prec, F.lit(0.0)), F.coalesce(rec, F.lit(0.0))).toDF("accuracy", "precision", "recall")
    base = base.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                         F.col("precision") + F.col("recall")), F.lit(0.0)))
    s = score or prediction
    return attach_row(attach_row(base, roc_auc(df, truth, s)), average_precision(df, truth, s))


def fold_mean(scores: DataFrame, value: str, digits: int = 2) -> DataFrame:
    """Mean of per-fold scores rounded to ``digits``."""
    return scores.agg(F.round(F.avg(value), digits).alias(f"mean_{value}"))


def weighted_mean(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Σ value·n / Σ n (the running-average meter, in one aggregate)."""
    return df.agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(f"weighted_{value}"))


def multiclass_accuracy(df: DataFrame, truth: str = "label", prediction: str = "prediction") -> DataFrame:
    """Percentage of rows whose prediction equals the label."""
    return df.agg((F.avg((F.col(truth) == F.col(prediction)).cast("double")) * 100).alias("accuracy_pct"))


def log_loss(df: DataFrame, truth: str = "label", probability: str = "p") -> DataFrame:
    """Mean negative log-likelihood of binary probabilities."""
    eps = 1e-15
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    y = F.col(truth).cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))
