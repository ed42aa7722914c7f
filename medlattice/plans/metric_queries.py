"""Registered metric queries (A19, A21-A26, M17) over deterministic
predictions derived from the tables: a threshold rule on the event count
for the binary task, and the arg-max of the first ten embedding components
for the ten-class task."""

from __future__ import annotations

from pyspark.sql import functions as F

from medlattice.functions.scalars import argmax_index, stable_uniform, stable_uniform_sql
from medlattice.operators import cohort, metrics
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query
from medlattice.session import written
from medlattice.sources import fixtures as sfx

FOLDS = 5
FOLD_SEED = 6505
THRESHOLD = 0.5


def _scored(fx):
    """label (dead=1), score = events / max events, prediction = score >= 0.5."""
    # Only what is read below: the other columns of a profile take a shuffle of their own.
    prof = written(cohort.patient_profile(fx.events, fx.mortality).select("patient_id", "cohort", "event_count"), "profiles")
    top = prof.agg(F.max("event_count").alias("_max"))
    s = metrics.attach_row(prof, top)
    return s.select("patient_id", (F.col("cohort") == cohort.DEAD).cast("int").alias("label"),
                    (F.col("event_count") / F.col("_max")).alias("score")).withColumn(
        "prediction", (F.col("score") >= THRESHOLD).cast("int"))


_SCORED = ("scored", f"""
SELECT patient_id, label, score, CAST(score >= {THRESHOLD} AS INT) AS prediction
FROM (SELECT patient_id, CAST(cohort = 'dead' AS INT) AS label,
             CAST(event_count AS DOUBLE) / max(event_count) OVER () AS score FROM prof) s""")

_CURVE = ("curve", """
SELECT score, pos, neg,
       COALESCE(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
       sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
       sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score) t""")


@query("binary_metrics", with_views(["prof"], """
SELECT round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 9) AS accuracy,
       round(prec, 9) AS precision, round(rec, 9) AS recall,
       round(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END, 9) AS f1,
       round(auc, 9) AS auc, round(ap, 9) AS average_precision
FROM (SELECT tp, fp, fn, tn,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0) AS prec,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0) AS rec
      FROM (SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
                   sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
                   sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn,
                   sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn FROM scored) c) m,
     (SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc,
             sum(pos * CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg)) / sum(pos) AS ap FROM curve) a""",
    [_SCORED, _CURVE]), ("A22", "A23", "M4"))
def q_binary_metrics(fx):
    """Accuracy, precision, recall, F1, ROC AUC and average precision."""
    m = metrics.binary_metrics(_scored(fx), "label", "prediction", "score")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("roc_curve", with_views(["prof"], """
SELECT score AS threshold, round(CAST(cum_neg AS DOUBLE) / (SELECT sum(neg) FROM curve), 9) AS fpr,
       round(CAST(cum_pos AS DOUBLE) / (SELECT sum(pos) FROM curve), 9) AS tpr FROM curve""",
    [_SCORED, _CURVE]), ("A23",))
def q_roc_curve(fx):
    """ROC points (false and true positive rate) per distinct score threshold."""
    c = metrics.roc_curve(_scored(fx), "label", "score")
    return c.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query("log_loss", with_views(["prof"], """
SELECT round(-avg(label * ln(p) + (1 - label) * ln(1 - p)), 9) AS log_loss
FROM (SELECT label, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM scored) s""", [_SCORED]), ("M17",))
def q_log_loss(fx):
    """Mean log loss of the score taken as a probability."""
    m = metrics.log_loss(_scored(fx), "label", "score")
    return m.select(F.round("log_loss", 9).alias("log_loss"))


_FOLD_U = stable_uniform_sql("patient_id", FOLD_SEED)


@query("cv_fold_accuracy", with_views(["prof"], f"""
SELECT round(avg(acc), 2) AS mean_accuracy FROM (
  SELECT CAST(floor(({_FOLD_U}) * {FOLDS}) AS INT) AS fold,
         avg(CAST(label = prediction AS DOUBLE)) AS acc FROM scored GROUP BY 1) f""", [_SCORED]), ("A24", "M5"))
def q_cv_fold_accuracy(fx):
    """Mean of per-fold accuracies (hashed 5-fold assignment), rounded to 2."""
    s = _scored(fx).withColumn("fold", F.floor(stable_uniform("patient_id", FOLD_SEED) * FOLDS).cast("int"))
    per_fold = s.groupBy("fold").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))
    return metrics.fold_mean(per_fold, "accuracy")


def _argmax_preds(fx):
    e = sfx.embeddings(fx.spark, fx.dir)
    return e.select("vec_id", "label", argmax_index(F.slice("embedding", 1, 10)).alias("prediction"))


_PREDS = ("preds", """
SELECT vec_id, label,
       CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS INT) AS prediction
FROM embeddings""")


@query("confusion_matrix", with_views([], """
SELECT label AS truth, prediction, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY label), 9) AS fraction
FROM preds GROUP BY label, prediction""", [_PREDS]), ("A21", "F15"))
def q_confusion_matrix(fx):
    """Counts and row shares per (true class, predicted class)."""
    c = metrics.confusion_matrix(_argmax_preds(fx), "label", "prediction")
    return c.select("truth", "prediction", "n", F.round("fraction", 9).alias("fraction"))


@query("multiclass_accuracy", with_views([], """
SELECT round(avg(CAST(label = prediction AS DOUBLE)) * 100, 9) AS accuracy_pct FROM preds""", [_PREDS]),
       ("A26",))
def q_multiclass_accuracy(fx):
    """Share (%) of vectors whose arg-max class equals the label."""
    m = metrics.multiclass_accuracy(_argmax_preds(fx))
    return m.select(F.round("accuracy_pct", 9).alias("accuracy_pct"))


@query("weighted_accuracy", with_views([], """
SELECT round(sum(acc * n) / sum(n), 9) AS weighted_accuracy FROM (
  SELECT label, avg(CAST(label = prediction AS DOUBLE)) AS acc, count(*) AS n FROM preds GROUP BY label) g""",
    [_PREDS]), ("A25",))
def q_weighted_accuracy(fx):
    """Per-class accuracies averaged with class sizes as weights."""
    g = _argmax_preds(fx).groupBy("label").agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))
    m = metrics.weighted_mean(g, "accuracy", "n")
    return m.select(F.round("weighted_accuracy", 9).alias("weighted_accuracy"))


@query("cluster_purity", with_views([], """
SELECT round(CAST(sum(best) AS DOUBLE) / sum(size), 9) AS purity, CAST(sum(size) AS BIGINT) AS n FROM (
  SELECT prediction, max(c) AS best, sum(c) AS size FROM (
    SELECT prediction, label, count(*) AS c FROM preds GROUP BY prediction, label) x GROUP BY prediction) y""",
    [_PREDS]), ("A19",))
def q_cluster_purity(fx):
    """Purity of the arg-max grouping against the labels."""
    p = metrics.purity(_argmax_preds(fx), cluster="prediction", label="label")
    return p.select(F.round("purity", 9).alias("purity"), "n")
