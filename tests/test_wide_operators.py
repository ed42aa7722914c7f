"""Sparse vectors, svmlight text, components of wide data, scoring under many models, clusters on a threshold graph, published artefacts."""

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from medlattice.operators import clusters, components, models, scoring, similarity, vectors
from medlattice.sources import artefacts


def test_sparse_vectors(spark):
    rows = [(1, 999_999, 3.0), (1, 5, 2.0), (2, 0, None), (3, 7, 1.5)]
    df = spark.createDataFrame(rows, "patient_id long, feature_idx long, value double")
    got = {r.patient_id: r.features for r in vectors.sparse_vectors(df, 1_000_000).collect()}
    assert got == {1: SparseVector(1_000_000, {5: 2.0, 999_999: 3.0}), 2: SparseVector(1_000_000, {0: 0.0}), 3: SparseVector(1_000_000, {7: 1.5})}
    back = vectors.vector_entries(vectors.sparse_vectors(df, 1_000_000), "patient_id").collect()
    assert sorted(map(tuple, back)) == [(1, 5, 2.0), (1, 999_999, 3.0), (2, 0, 0.0), (3, 7, 1.5)]
    assert vectors.sparse_vectors(df.limit(0), 3).count() == 0
    for width, extra in ((999_999, []), (1_000_000, [(1, 5, 1.0)]), (1_000_000, [(1, -1, 1.0)]), (1_000_000, [(4, None, 1.0)])):
        bad = spark.createDataFrame(rows + extra, df.schema)
        with pytest.raises(Exception, match="index"):
            vectors.sparse_vectors(bad, width).collect()
    empty = spark.createDataFrame([(1, None), (2, [])], "k long, pairs array<struct<idx:long,value:double>>")
    assert [r.features for r in vectors.pairs_to_vectors(empty, 4).orderBy("k").collect()] == [Vectors.sparse(4, [])] * 2


def test_svmlight_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text("7 1 0:0.5 12:2.5\n\n8 0 # nothing\n9 1 3:1e-3\n")
    df = vectors.read_svmlight_sparse(spark, str(tmp_path), with_id=True)
    got = {r.patient_id: (r.label, r.features) for r in df.collect()}
    assert got == {7: (1.0, SparseVector(13, {0: 0.5, 12: 2.5})), 8: (0.0, SparseVector(13, {})), 9: (1.0, SparseVector(13, {3: 0.001}))}
    with pytest.raises(Exception, match="outside 0 to 11"):
        vectors.read_svmlight_sparse(spark, str(tmp_path), 12, with_id=True).collect()
    for i, text in enumerate(("7 1 a:1", "7 1 3:x", "7 y 3:1", "7 1 31", "z 1 3:1", "7")):
        (tmp_path / f"bad{i}").mkdir()
        (tmp_path / f"bad{i}" / "part.txt").write_text(text)
        with pytest.raises(Exception, match=f"bad{i}/part.txt: {text}"):
            vectors.read_svmlight_sparse(spark, str(tmp_path / f"bad{i}"), 50, with_id=True).collect()


@pytest.mark.parametrize("broadcast", [True, False])
def test_components_of_a_small_matrix(spark, broadcast):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(60, 4)) @ np.diag([9, 5, 3, 1]) @ rng.normal(size=(4, 25)) + 0.01 * rng.normal(size=(60, 25)) + 4
    a[rng.random(a.shape) < 0.4] = 0
    a[59] = 0
    rows = [(i, j, float(a[i, j])) for i in range(59) for j in range(25) if a[i, j]] + [(None, 1, 1.0), (1, None, 1.0)]
    e = spark.createDataFrame(rows, "patient_id long, idx long, value double")
    scores, comps, variances = components.principal_components(e, 3, keys=spark.range(60).withColumnRenamed("id", "patient_id"), salt_target=10,
                                                               broadcast_basis=broadcast, tolerance=1e-11)
    c = a - a.mean(axis=0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    q = np.array([r[1:] for r in sorted(comps.collect())])
    assert np.allclose(variances, s[:3] ** 2 / 59, rtol=1e-8) and np.allclose(q.T @ q, np.eye(3), atol=1e-9)
    assert np.allclose(np.abs(np.sum(q * vt[:3].T, axis=0)), 1, atol=1e-6) and (q[np.abs(q).argmax(axis=0), range(3)] > 0).all()
    y = np.array([r[1:] for r in sorted(scores.collect())])
    assert y.shape == (60, 3) and np.allclose(y, c @ q, atol=1e-8)


def test_components_of_wide_data(spark):
    """50,000 columns, of which two groups move together."""
    base = spark.range(400).select(F.col("id").alias("patient_id"), F.explode(F.sequence(F.lit(0), F.lit(124))).alias("j"))
    group = F.col("patient_id") % 2
    idx = F.when(F.col("j") < 100, group * 100 + F.col("j")).otherwise(200 + F.col("patient_id") * 25 + F.col("j") - 100 + 39_800 * (F.col("patient_id") == 399).cast("int"))
    e = base.select("patient_id", idx.cast("long").alias("idx"), F.lit(1.0).alias("value"))
    scores, comps, variances = components.principal_components(e, 1, tolerance=1e-6)
    assert comps.agg(F.max("idx")).first()[0] == 49_999 and abs(comps.agg(F.sum(F.col("c0") * F.col("c0"))).first()[0] - 1) < 1e-9
    sides = {(r.patient_id % 2, r.c0 > 0) for r in scores.collect()}
    assert len(sides) == 2 and variances[0] == pytest.approx(50.2, abs=0.5)


def test_components_without_directions(spark):
    none = spark.createDataFrame([], "patient_id long, idx long, value double")
    flat = spark.createDataFrame([(i, j, 2.0) for i in range(5) for j in range(3)], none.schema)
    for e in (none, flat, flat.where("patient_id = 0")):
        scores, comps, variances = components.principal_components(e, 2)
        assert variances == [] and scores.count() == 0 and comps.count() == 0


def test_components_of_close_variances(spark):
    """75 independent columns, whose variances differ little: few columns settle in two rounds."""
    rng = np.random.default_rng(3)
    a = rng.normal(size=(300, 75)) * np.linspace(1, 1.1, 75)
    e = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(300) for j in range(75)], "patient_id long, idx long, value double")
    _, _, variances = components.principal_components(e, 5, max_rounds=3)
    s = np.linalg.svd(a - a.mean(axis=0), compute_uv=False)
    assert np.allclose(variances, s[:5] ** 2 / 299, rtol=1e-9)


@pytest.mark.parametrize("n_models", [1, 16, 37])
def test_many_models(spark, n_models):
    rng = np.random.default_rng(n_models)
    w = {(m, i): float(rng.normal()) for m in range(n_models) for i in range(9) if rng.random() < 0.5 or i == 0}
    x = {p: {i: float(rng.normal()) for i in range(12) if rng.random() < 0.3 or (i == 0 and p % 3)} for p in range(50)}
    weights = spark.createDataFrame([(10 * m, i, v) for (m, i), v in w.items()] + [(None, 1, 9.0)], "model_id long, idx long, weight double")
    samples = spark.createDataFrame([(p, list(f.items())) for p, f in x.items()], "patient_id long, pairs array<struct<idx:long,value:double>>")
    want = {p: np.mean([1 / (1 + np.exp(-sum(v * w.get((m, i), 0.0) for i, v in f.items()))) for m in range(n_models)]) for p, f in x.items()}
    plain = dict(map(tuple, models.ensemble_probability(weights.dropna(), samples).collect()))
    for broadcast, salt in ((True, 100), (False, 4)):
        got = dict(map(tuple, scoring.many_model_probability(weights, samples, salt_target=salt, broadcast_weights=broadcast).collect()))
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 and abs(got[p] - plain[p]) < 1e-12 for p in want)
    assert scoring.many_model_probability(weights.limit(0), samples).first().probability is None


def test_threshold_clusters(spark):
    """Two groups of much alike patients, copies, patients alike to nobody and one without codes: all come out, groups apart."""
    rows = []
    for p in range(40):
        own = range(8) if p < 20 else range(100, 108)
        rows += [(p, f"c{c}") for c in own if c % 8 != p % 8 or p % 5 == 0]
    rows += [(50, "alone"), (51, "other"), (None, "c1"), (3, None)]
    df = spark.createDataFrame(rows, "patient_id long, code string")
    patients = spark.range(53).where("id < 40 or id >= 50").withColumnRenamed("id", "patient_id")
    runs = []
    for parts in (2, 9):
        out = clusters.threshold_clusters(df.repartition(parts), patients.repartition(parts), (1, 2), k=5, seed=3, code_cols=("code",)).collect()
        runs.append(sorted(map(tuple, out)))
    got = dict(runs[0])
    assert runs[0] == runs[1] and len(runs[0]) == 43
    assert {got[p] for p in range(20)} != {got[p] for p in range(20, 40)} and all(len({got[p] for p in g}) == 1 for g in (range(20), range(20, 40)))
    assert len({got[p] for p in (0, 20, 50, 51, 52)}) == 5


def test_one_round_keeps_means(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")], "patient_id long, code string")
    members, vertices, edges = clusters.class_graph(df, df.select("patient_id"), (1, 2), ("code",))
    assert sorted(map(tuple, members.collect())) == [(1, 1), (2, 2), (3, 1)]
    start = spark.createDataFrame([(1, 1.0), (2, 0.0)], "class_id long, value double")
    assert {r.class_id: round(r.value, 12) for r in clusters.averaged(edges, start).collect()} == {1: round(2 / 2.5, 12), 2: 0.5}
    line = spark.createDataFrame([(1, 0.0, 1), (2, 0.1, 3), (3, 5.0, 1), (4, 5.0, 1)], "class_id long, value double, members long")
    assert [r.cluster for r in clusters.clusters_on_line(line, 2).orderBy("class_id").collect()] == [0, 0, 1, 1]
    assert [r.cluster for r in clusters.clusters_on_line(line, 9).orderBy("class_id").collect()] == [0, 1, 2, 2]
    assert clusters.clusters_on_line(line.limit(0), 2).count() == 0


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "published")
    with pytest.raises(FileNotFoundError):
        artefacts.read_table(spark, root, "weights")
    assert artefacts.publish_table(spark.range(3), root, "weights") == 1
    assert artefacts.publish_table(spark.range(5), root, "weights") == 2
    with pytest.raises(Exception, match="broken"):
        artefacts.publish_table(spark.range(7).select(F.when(F.col("id") > 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), root, "weights")
    assert artefacts.read_table(spark, root, "weights").count() == 5 and artefacts.read_table(spark, root, "weights", 1).count() == 3
    assert [r.rows for r in artefacts.versions(spark, root).orderBy("version").collect()] == [3, 5]
    data = spark.createDataFrame([(i, float(i % 2), Vectors.dense([i % 2 + 0.1 * i, 1.0])) for i in range(20)], ["patient_id", "label", "features"])
    model = models.logistic_regression(data)
    assert artefacts.publish_model(spark, model, root, "model") == 1
    again = artefacts.read_model(spark, root, "model")
    assert models.predictions_frame(again, data).collect() == models.predictions_frame(model, data).collect()


def test_class_graph_builds_sets_once(spark):
    """The records are read by one step that is written; members and vertices are plain scans, however often they are used."""
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")], "patient_id long, code string")
    members, vertices, _ = clusters.class_graph(df, df.select("patient_id"), (1, 2), ("code",))
    assert "Join" not in vertices._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in similarity.set_classes(df, ("code",))[0]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, members.collect())) == [(1, 1), (2, 2), (3, 1)]
