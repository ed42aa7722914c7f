"""Registered model queries (M1-M19, G7 aside). Model outputs are checked
rows-only; deterministic building blocks (folds, splits, bagging fan-out,
standardization, one streaming k-means update) have DuckDB oracles."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from medlattice.functions.scalars import stable_uniform, stable_uniform_sql
from medlattice.operators import cohort, features, metrics, models, phenotype, sequences, vectors
from medlattice.operators.indexing import dense_index
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query
from medlattice.session import written
from medlattice.sources import fixtures as sfx

N_MODELS = 5
BAG_RATIO = 0.5
CV_ROUNDS = 5


def _feature_vectors(fx):
    """patient_id, label, features (D5a vectors), split (hashed 80/20), written once: fits read them many times."""
    idx = cohort.index_dates(fx.events, fx.mortality)
    filt = cohort.observation_window(fx.events, idx)
    fmap = features.feature_map_by_name(fx.events)
    agg = written(features.aggregate_events(filt, fmap), "event-sums")
    n = fmap.count()
    vec = features.assemble_vectors(agg, n, idx="feature_id", value="feature_value")
    lab = agg.groupBy("patient_id").agg(F.max("label").alias("label"))
    return written(features.split_samples(vec.join(lab, "patient_id")), "feature-vectors")


def _fit_predict(fx, fit):
    data = _feature_vectors(fx)
    model = fit(data.where(F.col("split") == "train"))
    return models.predictions_frame(model, data.where(F.col("split") == "test"))


@query("logistic_regression_predictions", None, ("M1", "F14", "K5"))
def q_logistic_regression_predictions(fx):
    """Test-split predictions of L2 logistic regression on the event features."""
    return _fit_predict(fx, models.logistic_regression)


@query("svm_predictions", None, ("M2",))
def q_svm_predictions(fx):
    """Test-split predictions of a linear SVM (score = raw margin)."""
    return _fit_predict(fx, models.linear_svm)


@query("decision_tree_predictions", None, ("M3",))
def q_decision_tree_predictions(fx):
    """Test-split predictions of a depth-5 decision tree."""
    return _fit_predict(fx, models.decision_tree)


@query("classifier_metrics", None, ("M4", "A22"))
def q_classifier_metrics(fx):
    """Accuracy, AUC, precision, recall, F1 of the three classifiers on the test split."""
    data = _feature_vectors(fx)
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    preds = {name: models.predictions_frame(fit(train), test) for name, fit in
             (("logistic_regression", models.logistic_regression), ("linear_svm", models.linear_svm),
              ("decision_tree", models.decision_tree))}
    return models.classifier_report(preds)


_FOLD = stable_uniform_sql("patient_id", models.BAG_SEED)


@query("cv_folds", with_views(["ev"], f"""
SELECT patient_id, CAST(floor(({_FOLD}) * 5) AS INT) AS fold FROM (SELECT DISTINCT patient_id FROM ev) p"""),
       ("M5",))
def q_cv_folds(fx):
    """Stable 5-fold assignment of every patient."""
    return models.add_folds(fx.events.select("patient_id").distinct(), 5)


@query("kfold_cv_scores", None, ("M5", "A24"))
def q_kfold_cv_scores(fx):
    """Per-fold accuracy and AUC of logistic regression, 5 hashed folds."""
    return models.kfold_scores(_feature_vectors(fx).drop("split"), models.logistic_regression, 5)


_ROUND_U = stable_uniform_sql("patient_id", models.BAG_SEED, "round")


@query("random_cv_splits", with_views(["ev"], f"""
SELECT patient_id, CAST(round AS INT) AS round, CASE WHEN {_ROUND_U} < 0.2 THEN 'test' ELSE 'train' END AS split
FROM (SELECT patient_id, unnest(range(0, {CV_ROUNDS})) AS round FROM (SELECT DISTINCT patient_id FROM ev) p) r"""),
       ("M6",))
def q_random_cv_splits(fx):
    """Test/train assignment of every patient in each of 5 random 80/20 rounds."""
    return models.random_splits(fx.events.select("patient_id").distinct(), CV_ROUNDS, 0.2).select(
        "patient_id", "round", "split")


@query("randomized_cv_scores", None, ("M6",))
def q_randomized_cv_scores(fx):
    """Accuracy and AUC of logistic regression over 5 random 80/20 rounds."""
    return models.randomized_cv_scores(_feature_vectors(fx).drop("split"), models.logistic_regression,
                                       CV_ROUNDS, 0.2)


def _bag_samples(fx):
    """patient_id, label, pairs (ascending by idx) from the count features (D5b) with window labels, written once."""
    idx = cohort.index_dates(fx.events, fx.mortality)
    filt = cohort.observation_window(fx.events, idx)
    feats = features.count_features(filt)
    # pairs ascending by index, as in an svmlight line: the SGD pass is
    # order-sensitive, so the order must not depend on the shuffle
    return written(feats.groupBy("patient_id").agg(F.max("label").alias("label"), F.array_sort(F.collect_list(F.struct(
        F.col("idx").cast("int").alias("idx"), F.col("normalized_value").alias("value")))).alias("pairs")), "samples")


_BAG_U = stable_uniform_sql("patient_id", models.BAG_SEED, "model_id")


@query("bagging_assignments", with_views(["ev"], f"""
SELECT patient_id, CAST(model_id AS INT) AS model_id FROM (
  SELECT patient_id, unnest(range(1, {N_MODELS + 1})) AS model_id FROM (SELECT DISTINCT patient_id FROM ev) p) r
WHERE {_BAG_U} < {BAG_RATIO}"""), ("M7", "X3", "F17"))
def q_bagging_assignments(fx):
    """Which of 5 models each patient's sample goes to (probability 0.5 each)."""
    return models.bagging_fanout(fx.events.select("patient_id").distinct(), N_MODELS, BAG_RATIO).select(
        "patient_id", F.col("model_id").cast("int").alias("model_id"))


def _sgd_weights(fx, samples):
    bagged = models.bagging_fanout(samples, N_MODELS, BAG_RATIO)
    n_feature = fx.events.select("event_id").distinct().count()
    return models.train_sgd_ensemble(bagged, n_feature, eta=0.01, mu=0.0)


@query("sgd_ensemble_weights", None, ("M8", "S11"))
def q_sgd_ensemble_weights(fx):
    """Non-zero weights of 5 bagged SGD logistic regressions."""
    return _sgd_weights(fx, _bag_samples(fx))


@query("ensemble_predictions", None, ("M9", "F13"))
def q_ensemble_predictions(fx):
    """Mean sigmoid probability of the 5 SGD models for every sample."""
    samples = _bag_samples(fx)
    w = written(_sgd_weights(fx, samples), "weights")
    p = models.ensemble_probability(w, samples)
    return p.join(samples.select("patient_id", "label"), "patient_id").withColumn(
        "prediction", (F.col("probability") > 0.5).cast("int"))


def _embedding_vectors(fx):
    e = sfx.embeddings(fx.spark, fx.dir)
    return e.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("standardized_embeddings", with_views([], """
SELECT el.vec_id, el.dim,
       round(CASE WHEN s.sd = 0 OR s.sd IS NULL THEN 0.0 ELSE (el.x - s.mu) / s.sd END, 6) AS value
FROM el JOIN (SELECT dim, avg(x) AS mu, stddev_samp(x) AS sd FROM el GROUP BY dim) s ON s.dim = el.dim""",
    [("el", """SELECT e.vec_id, CAST(t.i AS INT) - 1 AS dim, CAST(t.x AS DOUBLE) AS x
               FROM embeddings e, unnest(e.embedding) WITH ORDINALITY AS t(x, i)""")]), ("M10",))
def q_standardized_embeddings(fx):
    """Embeddings scaled to zero mean and unit sample deviation, long form."""
    v = _embedding_vectors(fx)
    scaled = models.standardize(v).transform(v)
    return (scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("dim", "value"))
            .select("vec_id", F.col("dim").cast("int").alias("dim"), F.round("value", 6).alias("value")))


@query("pca_embeddings", None, ("M11", "M19"))
def q_pca_embeddings(fx):
    """Scaled embeddings projected on 10 principal components."""
    v = _embedding_vectors(fx)
    scaled = models.standardize(v).transform(v)
    proj = models.pca(scaled, 10).transform(scaled)
    return proj.select("vec_id", vector_to_array("pca").alias("pca"))


def _patient_vectors(fx):
    """patient_id, features; tuples and vectors are each written once, as scaling, components and clusters read them in many rounds."""
    t = written(features.feature_tuples_from_records(fx.records), "tuples")
    long_df = features.feature_vectors_long(t)
    n = t.select("source", "feature_name").distinct().count()
    return written(features.assemble_vectors(long_df, n, idx="feature_idx", value="value"), "patient-vectors")


@query("kmeans_clusters", None, ("M12", "M15"))
def q_kmeans_clusters(fx):
    """k-means (k=3) cluster of every patient after scaling and PCA."""
    v = _patient_vectors(fx)
    return models.clustering_pipeline(model="kmeans").fit(v).transform(v).select("patient_id", "cluster")


@query("gmm_clusters", None, ("M13", "M15"))
def q_gmm_clusters(fx):
    """Gaussian-mixture (k=3) cluster of every patient after scaling and PCA."""
    v = _patient_vectors(fx)
    return models.clustering_pipeline(model="gmm").fit(v).transform(v).select("patient_id", "cluster")


@query("clustering_purity", None, ("M15", "A19", "J12", "J13"))
def q_clustering_purity(fx):
    """Purity of k-means and GMM clusters against the phenotype labels."""
    v = _patient_vectors(fx)
    labels = phenotype.phenotype_labels(fx.records, phenotype.FIXTURE_RULES)
    out = None
    for name in ("kmeans", "gmm"):
        a = models.clustering_pipeline(model=name).fit(v).transform(v).select("patient_id", "cluster")
        p = metrics.purity(a.join(labels, "patient_id")).withColumn("model", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out


_SKM_CTES = [
    ("pts", """SELECT e.vec_id, CAST(t.i AS INT) - 1 AS dim, CAST(t.x AS DOUBLE) AS x
               FROM embeddings e, unnest(e.embedding[1:10]) WITH ORDINALITY AS t(x, i)"""),
    ("c0", """SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS cluster, vec_id, CAST(0.5 AS DOUBLE) AS weight
              FROM embeddings QUALIFY row_number() OVER (ORDER BY vec_id) <= 3"""),
    ("cl", "SELECT c.cluster, c.weight, p.dim, p.x AS c FROM c0 c JOIN pts p ON p.vec_id = c.vec_id"),
    ("asg", """SELECT vec_id, cluster FROM (
                 SELECT p.vec_id, c.cluster, sum((p.x - c.c) * (p.x - c.c)) AS d FROM pts p JOIN cl c ON c.dim = p.dim
                 GROUP BY p.vec_id, c.cluster) q
               QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1"""),
]


@query("streaming_kmeans_update", with_views([], """
SELECT c.cluster, CAST(c.dim AS INT) AS dim, round(c.weight * 1.0 + COALESCE(m.m, 0), 9) AS weight,
       round((c.c * c.weight * 1.0 + COALESCE(s.s, 0)) / (c.weight * 1.0 + COALESCE(m.m, 0)), 9) AS value
FROM cl c
LEFT JOIN (SELECT cluster, count(*) AS m FROM asg GROUP BY cluster) m ON m.cluster = c.cluster
LEFT JOIN (SELECT a.cluster, p.dim, sum(p.x) AS s FROM asg a JOIN pts p ON p.vec_id = a.vec_id
           GROUP BY a.cluster, p.dim) s ON s.cluster = c.cluster AND s.dim = c.dim""", _SKM_CTES), ("M14",))
def q_streaming_kmeans_update(fx):
    """One streaming k-means update (decay 1) of 3 starting centers with all
    ten-dimensional points; starting centers = the first three vectors."""
    e = sfx.embeddings(fx.spark, fx.dir).select("vec_id", F.slice("embedding", 1, 10).cast("array<double>").alias("x"))
    first = dense_index(e, ["vec_id"], "cluster").where(F.col("cluster") < 3)
    centers = first.join(e, "vec_id").select(F.col("cluster").cast("int").alias("cluster"),
                                             F.col("x").alias("center"), F.lit(0.5).alias("weight"))
    upd = models.streaming_kmeans_update(centers, e, decay=1.0)
    return upd.select("cluster", F.posexplode("center").alias("dim", "value"), "weight").select(
        "cluster", F.col("dim").cast("int").alias("dim"), F.round("weight", 9).alias("weight"),
        F.round("value", 9).alias("value"))


@query("mlp_predictions", None, ("M16", "M17", "A26", "S8", "K8"))
def q_mlp_predictions(fx):
    """Multilayer perceptron (64 hidden units) on the embeddings: best of an
    iteration grid on validation, test predictions reported."""
    v = _embedding_vectors(fx)
    u = stable_uniform("vec_id", models.BAG_SEED)
    v = v.withColumn("part", F.when(u < 0.6, "train").when(u < 0.8, "validation").otherwise("test")).persist()
    model, _ = models.mlp_best(v.where(F.col("part") == "train"), v.where(F.col("part") == "validation"),
                               n_inputs=64, n_classes=10)
    out = model.transform(v.where(F.col("part") == "test"))
    return out.select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.array_max(vector_to_array("probability")).alias("confidence"))


@query("mortality_scores", None, ("M18", "K6", "D13"))
def q_mortality_scores(fx):
    """Probability of death per validation/test subject from logistic
    regression on the codes of their visit sequence (trained on train). A
    subject without known codes has the zero vector."""
    train = fx.admissions.where(F.col("split") == "train").select("hadm_id")
    cmap = sequences.build_codemap(fx.diagnoses_icd.join(train, "hadm_id", "left_semi"))
    long_df = written(sequences.visit_sequence_long(fx.admissions, fx.diagnoses_icd, cmap).select("subject_id", "split", "code_idx"), "visit-codes")
    n = cmap.count()
    counts = (long_df.where(F.col("code_idx").isNotNull())
              .groupBy("subject_id", "code_idx").agg(F.count(F.lit(1)).cast("double").alias("value")))
    pairs = counts.groupBy("subject_id").agg(F.collect_list(F.struct(F.col("code_idx").alias("idx"), "value")).alias("pairs"))
    subj = long_df.select("subject_id", "split").distinct()
    data = written(vectors.pairs_to_vectors(subj.join(pairs, "subject_id", "left"), n)
                   .join(sequences.subject_labels(fx.subject_mortality), "subject_id", "left")
                   .withColumn("label", F.col("label").cast("double")), "subject-vectors")
    model = models.logistic_regression(data.where(F.col("split") == "train"))
    scored = model.transform(data.where(F.col("split") != "train"))
    return scored.select("subject_id", "split", models.positive_probability(scored).alias("mortality"))


@query("streaming_kmeans_centers", None, ("Z1", "M14"))
def q_streaming_kmeans_centers(fx):
    """Structured-Streaming k-means over the embeddings stream: final centers."""
    from medlattice.streaming.kmeans import streaming_kmeans_centers

    return streaming_kmeans_centers(fx.spark, fx.dir, k=3, dim=10)
