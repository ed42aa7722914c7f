"""Registered queries of sparse vectors, svmlight round trips, wide components, ensembles of many models, clusters on the threshold graph and
published artefacts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from medlattice.operators import clusters, components, features, scoring, vectors
from medlattice.plans.cohort_queries import _COUNT_SQL, _filtered
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.model_queries import _bag_samples
from medlattice.plans.phenotype_queries import _TUPLES_SQL
from medlattice.plans.registry import query
from medlattice.plans.scale_queries import _CLASSES, _SETS, SIMILAR
from medlattice.session import ensure_checkpoint_dir, written
from medlattice.sources import artefacts, writers

ENSEMBLE = 100
WALK_ROUNDS = 6
CLUSTERS = 3
COMPONENTS = 5


def _folder(fx, label: str) -> str:
    return f"{ensure_checkpoint_dir(fx.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@query("sparse_feature_vectors", with_views(["line"], """
SELECT t.patient_id, CAST(i.feature_idx AS INT) AS idx, round(t.value, 9) AS value, (SELECT count(*) FROM i) AS width
FROM t JOIN i ON t.source = i.source AND t.feature_name = i.feature_name""",
    [("t", _TUPLES_SQL.format(d="", m="", l="")),
     ("i", """SELECT source, feature_name, row_number() OVER (ORDER BY source, feature_name) - 1 AS feature_idx
              FROM (SELECT DISTINCT source, feature_name FROM t) d""")]), ("F19", "D8", "J14"))
def q_sparse_feature_vectors(fx):
    """The stored entries of the patients' sparse feature vectors, and the vectors' width."""
    t = features.feature_tuples_from_records(fx.records)
    width = t.select("source", "feature_name").distinct().count()
    v = vectors.sparse_vectors(features.feature_vectors_long(t), width)
    return vectors.vector_entries(v, "patient_id").select("patient_id", "idx", F.round("value", 9).alias("value"), F.lit(width).cast("long").alias("width"))


@query("svmlight_round_trip", with_views([], f"""
SELECT c.patient_id, CAST(c.label AS DOUBLE) AS label, CAST(c.idx AS INT) AS idx, round(c.nv, 6) AS value
FROM (SELECT a.patient_id, a.idx, a.normalized_value AS nv, l.label FROM ({_COUNT_SQL}) a
      JOIN ({with_views(["filt"], "SELECT DISTINCT patient_id, label FROM filt")}) l ON l.patient_id = a.patient_id) c"""),
       ("S7", "K3", "K4", "F9", "F19"))
def q_svmlight_round_trip(fx):
    """svmlight text of the count features, written to files and read back as sparse vectors whose width is found while reading."""
    rows = features.svmlight_text(features.svmlight_rows(features.count_features(_filtered(fx)), idx="idx", value="normalized_value"), with_id=True)
    path = _folder(fx, "svmlight")
    writers.write_text_lines(rows, path)
    read = vectors.read_svmlight_sparse(fx.spark, path, with_id=True)
    return vectors.vector_entries(read, "patient_id").join(read.select("patient_id", "label"), "patient_id").select("patient_id", "label", "idx", "value")


@query("wide_components", None, ("M11", "M19"))
def q_wide_components(fx):
    """The patients' first components over their events, a column for each event."""
    counts = features.count_features(_filtered(fx))
    scores, _, _ = components.principal_components(counts.select("patient_id", "idx", F.col("normalized_value").alias("value")), COMPONENTS)
    return scores


# A fixed rule gives every model its weights: multiples of 1/20 from -0.45 to 0.45.
_WEIGHT = "(((model_id * 31 + idx * 17 + model_id * idx) % 19) - 9) / 20.0"


def _given_weights(samples):
    idx = samples.select(F.explode("pairs.idx").alias("idx")).distinct().select(F.col("idx").cast("long"))
    return idx.select(F.explode(F.sequence(F.lit(1), F.lit(ENSEMBLE))).alias("model_id"), "idx").withColumn("weight", F.expr(f"CAST({_WEIGHT} AS DOUBLE)"))


_SCORES_SQL = with_views([], f"""
SELECT patient_id, round(avg(1.0 / (1.0 + exp(-margin))), 9) AS probability
FROM (SELECT c.patient_id, m.model_id, sum(c.normalized_value * CAST({_WEIGHT} AS DOUBLE)) AS margin
      FROM ({_COUNT_SQL}) c CROSS JOIN (SELECT unnest(range(1, {ENSEMBLE + 1})) AS model_id) m
      GROUP BY c.patient_id, m.model_id) s
GROUP BY patient_id""")


@query("ensemble_scores", _SCORES_SQL, ("M9", "F13"))
def q_ensemble_scores(fx):
    """Mean probability of a hundred models with given weights for every sample."""
    samples = written(_bag_samples(fx), "samples")
    p = scoring.many_model_probability(_given_weights(samples), samples)
    return p.select("patient_id", F.round("probability", 9).alias("probability"))


@query("published_model_scores", _SCORES_SQL, ("K8", "S11", "K5"))
def q_published_model_scores(fx):
    """The same scores from published weights: a first version of zeros is replaced by a second one, and the newest is read."""
    samples = written(_bag_samples(fx), "samples")
    weights, root = _given_weights(samples), _folder(fx, "published")
    artefacts.publish_table(weights.withColumn("weight", F.lit(0.0)), root, "weights")
    artefacts.publish_table(weights, root, "weights")
    p = scoring.many_model_probability(artefacts.read_table(fx.spark, root, "weights"), samples)
    return p.select("patient_id", F.round("probability", 9).alias("probability"))


def _averaging_sql() -> str:
    ctes = [_SETS, _CLASSES,
            ("sh", """SELECT l.patient_id AS p1, r.patient_id AS p2, count(*) AS i
                      FROM (SELECT DISTINCT patient_id, kind, code FROM graph_rec) l
                      JOIN (SELECT DISTINCT patient_id, kind, code FROM graph_rec) r
                        ON l.kind = r.kind AND l.code = r.code GROUP BY l.patient_id, r.patient_id"""),
            ("raw", f"""SELECT a.class_id AS src, b.class_id AS dst, CAST(s.i AS DOUBLE) / (a.n + b.n - s.i) * b.members AS w
                        FROM sh s JOIN cls a ON a.class_id = s.p1 JOIN cls b ON b.class_id = s.p2
                        WHERE {SIMILAR[1]} * s.i >= {SIMILAR[0]} * (a.n + b.n - s.i)
                        UNION ALL
                        SELECT s_suppkey, s_suppkey, 1.0 FROM supplier WHERE s_suppkey NOT IN (SELECT patient_id FROM graph_rec)"""),
            ("we", "SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM raw"),
            ("v0", "SELECT DISTINCT src AS class_id, CAST(src % 101 AS DOUBLE) AS value FROM we")]
    for i in range(WALK_ROUNDS):
        ctes.append((f"v{i + 1}", f"SELECT e.src AS class_id, sum(e.w * v.value) AS value FROM we e JOIN v{i} v ON v.class_id = e.dst GROUP BY e.src"))
    return with_views(["graph_rec"], f"SELECT class_id, round(value, 7) AS value FROM v{WALK_ROUNDS}", ctes)


@query("power_iteration_values", _averaging_sql(), ("G7",))
def q_power_iteration_values(fx):
    """Values of all classes of patients after some rounds of averaging over the graph of similarities of at least 1/20."""
    _, vertices, edges = clusters.class_graph(fx.graph_records, fx.graph_patients, SIMILAR)
    start = vertices.select("class_id", F.pmod("class_id", F.lit(101)).cast("double").alias("value"))
    values = clusters.power_iteration_values(edges, start, WALK_ROUNDS, tolerance=-1.0)
    return values.select("class_id", F.round("value", 7).alias("value"))


@query("threshold_clusters", None, ("G7",))
def q_threshold_clusters(fx):
    """Every patient's cluster by power iteration over the graph of similarities of at least 1/20."""
    return clusters.threshold_clusters(fx.graph_records, fx.graph_patients, SIMILAR, CLUSTERS)
