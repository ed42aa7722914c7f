"""Registered queries of the operators made for data that no single task can hold: similarity join above a
threshold, exact percentiles, trees without a depth limit, streaming k-means on whole vectors and over restarts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from medlattice.operators import cohort, metrics, models, quantiles, similarity, trees
from medlattice.operators.indexing import dense_index
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query
from medlattice.session import ensure_checkpoint_dir, written
from medlattice.sources import fixtures as sfx

SIMILAR = (1, 20)
QUANTILES = {"q1": 0.25, "median": 0.5, "q9": 0.9}

# Each patient's distinct (kind, code) pairs as one ordered text, so that equal sets are equal texts.
_SETS = ("sets", """
SELECT patient_id, string_agg(kind || ':' || code, ',' ORDER BY kind, code) AS codes, count(*) AS n
FROM (SELECT DISTINCT patient_id, kind, code FROM graph_rec) d GROUP BY patient_id""")
_CLASSES = ("cls", "SELECT min(patient_id) AS class_id, count(*) AS members, max(n) AS n FROM sets GROUP BY codes")


@query("jaccard_set_classes", with_views(["graph_rec"], """
SELECT patient_id, min(patient_id) OVER (PARTITION BY codes) AS class_id FROM sets""", [_SETS]), ("G4", "J15"))
def q_jaccard_set_classes(fx):
    """The class of each patient: the smallest patient with the same set of codes."""
    return similarity.set_classes(fx.graph_records)[0]


@query("jaccard_similar_pairs", with_views(["graph_rec"], f"""
SELECT x.p1 AS class_1, x.p2 AS class_2, a.members AS members_1, b.members AS members_2,
       round(CAST(x.i AS DOUBLE) / (a.n + b.n - x.i), 9) AS similarity
FROM (SELECT l.patient_id AS p1, r.patient_id AS p2, count(*) AS i
      FROM (SELECT DISTINCT patient_id, kind, code FROM graph_rec) l
      JOIN (SELECT DISTINCT patient_id, kind, code FROM graph_rec) r ON l.kind = r.kind AND l.code = r.code AND l.patient_id < r.patient_id
      GROUP BY l.patient_id, r.patient_id) x
JOIN cls a ON a.class_id = x.p1 JOIN cls b ON b.class_id = x.p2
WHERE {SIMILAR[1]} * x.i >= {SIMILAR[0]} * (a.n + b.n - x.i)""", [_SETS, _CLASSES]), ("G4", "J15", "G2", "U5"))
def q_jaccard_similar_pairs(fx):
    """Classes of patients with a Jaccard similarity of at least 1/20 over their codes."""
    _, classes = similarity.set_classes(fx.graph_records)
    return similarity.similar_classes(classes, SIMILAR).withColumn("similarity", F.round("similarity", 9))


def _quantile_sql() -> str:
    cols = ", ".join(f"round(quantile_cont(value, {share}), 9) AS {name}" for name, share in QUANTILES.items())
    return with_views(["ev", "mort"], f"""
SELECT event_id, CASE WHEN m.patient_id IS NOT NULL THEN 'dead' ELSE 'alive' END AS cohort, {cols}
FROM ev LEFT JOIN (SELECT DISTINCT patient_id FROM mort) m ON m.patient_id = ev.patient_id GROUP BY 1, 2""")


@query("event_value_quantiles", _quantile_sql(), ("A4",))
def q_event_value_quantiles(fx):
    """Exact quartile, median and ninth decile of the values of each event and cohort."""
    tagged = cohort.with_cohort(fx.events, fx.mortality)
    out = quantiles.exact_percentiles(tagged, ["event_id", "cohort"], "value", QUANTILES)
    return out.select("event_id", "cohort", *[F.round(c, 9).alias(c) for c in QUANTILES])


@query("cohort_medians", with_views(["prof"], """
SELECT cohort, round(quantile_cont(event_count, 0.5), 9) AS median_event_count FROM prof GROUP BY cohort"""), ("A4",))
def q_cohort_medians(fx):
    """Exact median number of events of a patient, without a cohort's values in one task."""
    prof = cohort.patient_profile(fx.events, fx.mortality)
    return quantiles.exact_percentiles(prof, ["cohort"], "event_count", {"median_event_count": 0.5}).withColumn(
        "median_event_count", F.round("median_event_count", 9))


@query("dead_patient_events", with_views(["ev", "mort"], """
SELECT event_id, count(*) AS n FROM ev WHERE patient_id IN (SELECT patient_id FROM mort) GROUP BY event_id"""), ("J5",))
def q_dead_patient_events(fx):
    """Events of patients with a date of death, by event id (semi join)."""
    return cohort.dead_events(fx.events, fx.mortality).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


@query("alive_patient_events", with_views(["ev", "mort"], """
SELECT event_id, count(*) AS n FROM ev WHERE patient_id NOT IN (SELECT patient_id FROM mort) GROUP BY event_id"""), ("J6", "P5"))
def q_alive_patient_events(fx):
    """Events of patients without a date of death, by event id (anti join)."""
    return cohort.alive_events(fx.events, fx.mortality).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


# Whole vectors: one row per component.
_POINTS = ("pts", """SELECT e.vec_id, CAST(t.i AS INT) - 1 AS dim, CAST(t.x AS DOUBLE) AS x, e.label
                     FROM embeddings e, unnest(e.embedding) WITH ORDINALITY AS t(x, i)""")
_START = [_POINTS,
          ("c0", """SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS cluster, vec_id, CAST(0.5 AS DOUBLE) AS weight
                    FROM embeddings QUALIFY row_number() OVER (ORDER BY vec_id) <= 3"""),
          ("cl0", "SELECT c.cluster, c.weight, p.dim, p.x AS c FROM c0 c JOIN pts p ON p.vec_id = c.vec_id")]


def _update_sql(i: int, decay: str, points: str) -> list[tuple[str, str]]:
    """CTEs from the centers cl{i} to cl{i+1} by the points with the condition."""
    return [(f"asg{i}", f"""SELECT vec_id, cluster FROM (
               SELECT p.vec_id, c.cluster, sum((p.x - c.c) * (p.x - c.c)) AS d FROM pts p JOIN cl{i} c ON c.dim = p.dim
               WHERE {points} GROUP BY p.vec_id, c.cluster) q
             QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1"""),
            (f"cl{i + 1}", f"""SELECT c.cluster, c.weight * {decay} + COALESCE(m.m, 0) AS weight, c.dim,
               CASE WHEN m.m IS NULL THEN c.c ELSE (c.c * c.weight * {decay} + s.s) / (c.weight * {decay} + m.m) END AS c
             FROM cl{i} c
             LEFT JOIN (SELECT cluster, count(*) AS m FROM asg{i} GROUP BY cluster) m ON m.cluster = c.cluster
             LEFT JOIN (SELECT a.cluster, p.dim, sum(p.x) AS s FROM asg{i} a JOIN pts p ON p.vec_id = a.vec_id
                        GROUP BY a.cluster, p.dim) s ON s.cluster = c.cluster AND s.dim = c.dim""")]


def _centers_sql(i: int) -> str:
    return f"SELECT cluster, CAST(dim AS INT) AS dim, round(weight, 9) AS weight, round(c, 9) AS value FROM cl{i}"


def _first_centers(vectors):
    first = dense_index(vectors, ["vec_id"], "cluster").where(F.col("cluster") < 3)
    return first.join(vectors, "vec_id").select(F.col("cluster").cast("int").alias("cluster"), F.col("x").alias("center"), F.lit(0.5).alias("weight"))


def _long_centers(centers):
    return centers.select("cluster", F.posexplode("center").alias("dim", "value"), "weight").select(
        "cluster", F.col("dim").cast("int").alias("dim"), F.round("weight", 9).alias("weight"), F.round("value", 9).alias("value"))


def _vectors(fx):
    return sfx.embeddings(fx.spark, fx.dir).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


@query("streaming_kmeans_whole_vectors", with_views([], _centers_sql(1), [*_START, *_update_sql(0, "pow(0.999, (SELECT count(*) FROM embeddings))", "true")]), ("M14",))
def q_streaming_kmeans_whole_vectors(fx):
    """One update of three centers with all components of all vectors, discounted by the number of points."""
    v = _vectors(fx)
    return _long_centers(models.streaming_kmeans_update(_first_centers(v), v, decay=0.999, unit="points"))


@query("streaming_kmeans_restarted", with_views([], _centers_sql(2), [
    *_START, *_update_sql(0, "0.5", "p.vec_id % 2 = 0"), *_update_sql(1, "0.5", "p.vec_id % 2 = 1")]), ("Z1", "M14"))
def q_streaming_kmeans_restarted(fx):
    """Centers after a stream over the even vectors that ends, and goes on with the odd ones when it is started again."""
    from medlattice.streaming.kmeans import latest_centers, run_streaming_kmeans

    v = _vectors(fx)
    base = f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/kmeans-batches-{uuid.uuid4().hex}"
    first, state = _first_centers(v), None
    for part in (0, 1):
        v.where(F.col("vec_id") % 2 == part).select("x").write.mode("append").parquet(f"{base}/points")
        stream = fx.spark.readStream.schema("x array<double>").parquet(f"{base}/points")
        state, _ = run_streaming_kmeans(fx.spark, stream, first, decay=0.5, work_dir=f"{base}/run")
    return _long_centers(latest_centers(fx.spark, state))


_NEAREST = [_POINTS, ("means", "SELECT label AS cluster, dim, avg(x) AS c FROM pts WHERE label IS NOT NULL GROUP BY label, dim"),
            ("preds", """SELECT vec_id, label, cluster AS prediction FROM (
                           SELECT p.vec_id, p.label, c.cluster, sum((p.x - c.c) * (p.x - c.c)) AS d FROM pts p JOIN means c ON c.dim = p.dim
                           GROUP BY p.vec_id, p.label, c.cluster) q
                         QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1""")]


def _nearest_mean(fx):
    """vec_id, label, prediction: the class whose mean over all components is nearest."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = _vectors(fx)
    means = v.where(F.col("label").isNotNull()).groupBy(F.col("label").alias("cluster")).agg(
        vector_to_array(Summarizer.mean(array_to_vector("x"))).alias("center"))
    return models.nearest_center(v, means).select("vec_id", "label", F.col("cluster").alias("prediction"))


@query("nearest_mean_confusion", with_views([], """
SELECT label AS truth, prediction, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY label), 9) AS fraction
FROM preds GROUP BY label, prediction""", _NEAREST), ("A21",))
def q_nearest_mean_confusion(fx):
    """Confusion matrix of the nearest class mean over whole vectors."""
    return metrics.confusion_matrix(_nearest_mean(fx), "label", "prediction").withColumn("fraction", F.round("fraction", 9))


@query("nearest_mean_scores", with_views([], """
SELECT round(avg(CAST(label = prediction AS DOUBLE)) * 100, 9) AS accuracy_pct,
       (SELECT round(CAST(sum(best) AS DOUBLE) / sum(size), 9) FROM (
          SELECT prediction, max(c) AS best, sum(c) AS size FROM (
            SELECT prediction, label, count(*) AS c FROM preds GROUP BY prediction, label) x GROUP BY prediction) y) AS purity
FROM preds""", _NEAREST), ("A19", "A25", "A26"))
def q_nearest_mean_scores(fx):
    """Accuracy and purity of the nearest class mean over whole vectors."""
    p = _nearest_mean(fx)
    row = metrics.attach_row(metrics.multiclass_accuracy(p), metrics.purity(p, cluster="prediction", label="label"))
    return row.select(F.round("accuracy_pct", 9).alias("accuracy_pct"), F.round("purity", 9).alias("purity"))


@query("unlimited_tree_predictions", None, ("M3",))
def q_unlimited_tree_predictions(fx):
    """Each vector's class (label 5 or more) by a tree grown without a depth limit on all vectors, and its leaf's depth."""
    rows = _vectors(fx).select("vec_id", (F.col("label") >= 5).cast("int").alias("label"), F.col("x").alias("features"))
    nodes = written(trees.grow_tree(rows, max_bins=32), "tree-nodes")
    return trees.tree_predictions(nodes, rows, "vec_id").join(rows.select("vec_id", "label"), "vec_id")
