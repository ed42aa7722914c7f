import math

import numpy as np
from pyspark.sql import functions as F

from medlattice.operators import models


def _brute_sgd(samples, n_feature, eta, mu):
    w = [0.0] * n_feature
    for pairs, y in samples:
        for f, v in pairs:
            p = 1.0 / (1.0 + math.exp(-math.fsum(w[g] * u for g, u in pairs)))
            w[f] = w[f] - eta * ((p - y) * v + 2 * mu * w[f])
    return w


def test_sgd_matches_sequential_definition(spark):
    rng = np.random.default_rng(1)
    rows = []
    for pid in range(40):
        idx = sorted(rng.choice(6, size=3, replace=False).tolist())
        rows.append((pid, 1 + pid % 2, int(pid % 3 == 0), [(int(i), float(rng.random())) for i in idx]))
    df = spark.createDataFrame(rows, "patient_id long, model_id int, label int, pairs array<struct<idx:int,value:double>>")
    got = {(r.model_id, r.idx): r.weight for r in models.train_sgd_ensemble(df, 6, eta=0.1, mu=0.01).collect()}
    for m in (1, 2):
        seq = [([(p[0], p[1]) for p in r[3]], r[2]) for r in rows if r[1] == m]
        want = _brute_sgd(seq, 6, 0.1, 0.01)
        for f in range(6):
            assert abs(got.get((m, f), 0.0) - want[f]) < 1e-9


def test_sharded_sgd_is_mean_of_sequential_shards(spark):
    rng = np.random.default_rng(2)
    rows = []
    for pid in range(40):
        idx = sorted(rng.choice(6, size=3, replace=False).tolist())
        rows.append((pid, 1 + pid % 2, int(pid % 3 == 0), [(int(i), float(rng.random())) for i in idx]))
    df = spark.createDataFrame(rows, "patient_id long, model_id int, label int, pairs array<struct<idx:int,value:double>>")
    # 20 rows per model, 7 per shard -> 3 shards, assigned by the id's hash
    got = {(r.model_id, r.idx): r.weight
           for r in models.train_sgd_ensemble(df, 6, eta=0.1, mu=0.01, rows_per_shard=7).collect()}
    shard = {r.patient_id: r.s for r in df.select(
        "patient_id", F.pmod(F.xxhash64("patient_id"), F.lit(3)).alias("s")).collect()}
    for m in (1, 2):
        want = [0.0] * 6
        for sh in range(3):
            seq = [([(p[0], p[1]) for p in r[3]], r[2]) for r in rows if r[1] == m and shard[r[0]] == sh]
            for f, v in enumerate(_brute_sgd(seq, 6, 0.1, 0.01)):
                want[f] += v / 3
        for f in range(6):
            assert abs(got.get((m, f), 0.0) - want[f]) < 1e-9


def test_single_model_ensemble_is_sigmoid(spark):
    w = spark.createDataFrame([(1, 0, 0.5), (1, 2, -1.0)], "model_id int, idx int, weight double")
    s = spark.createDataFrame([(7, [(0, 2.0), (2, 1.0)]), (8, [(1, 3.0)])],
                              "patient_id long, pairs array<struct<idx:int,value:double>>")
    got = {r.patient_id: r.probability for r in models.ensemble_probability(w, s).collect()}
    assert abs(got[7] - 0.5) < 1e-12 and abs(got[8] - 0.5) < 1e-12
    w2 = spark.createDataFrame([(1, 0, 1.0)], "model_id int, idx int, weight double")
    got2 = models.ensemble_probability(w2, s).where("patient_id = 7").first().probability
    assert abs(got2 - 1 / (1 + math.exp(-2.0))) < 1e-12


def test_bagging_ratio(spark):
    rows = spark.range(0, 3000).withColumnRenamed("id", "patient_id")
    b = models.bagging_fanout(rows, 4, 0.3)
    per_model = [r["count"] for r in b.groupBy("model_id").count().collect()]
    assert len(per_model) == 4 and all(750 < c < 1050 for c in per_model)


def test_streaming_update_matches_numpy(spark):
    centers = spark.createDataFrame([(0, [0.0, 0.0], 0.5), (1, [10.0, 10.0], 0.5), (2, [50.0, 50.0], 0.5)],
                                    "cluster int, center array<double>, weight double")
    pts = [[1.0, 0.0], [0.0, 2.0], [9.0, 11.0]]
    p = spark.createDataFrame([(x,) for x in pts], "x array<double>")
    got = {r.cluster: (r.weight, r.center) for r in models.streaming_kmeans_update(centers, p, 1.0).collect()}
    assert got[0][0] == 2.5 and np.allclose(got[0][1], [(0 * 0.5 + 1.0) / 2.5, (0 * 0.5 + 2.0) / 2.5])
    assert got[1][0] == 1.5 and np.allclose(got[1][1], [(5 + 9) / 1.5, (5 + 11) / 1.5])
    assert got[2] == (0.5, [50.0, 50.0])


def test_folds_cover(spark):
    rows = spark.range(0, 1000).withColumnRenamed("id", "patient_id")
    f = models.add_folds(rows, 5)
    assert sorted(r.fold for r in f.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]
    s = models.random_splits(rows, 3, 0.2)
    assert s.count() == 3000
    assert s.where(F.col("split") == "test").count() < 900


def test_fits_read_written_tables(spark):
    """What a fit reads again and again is a table of files: its plan repeats neither joins nor aggregates."""
    from medlattice.plans import metric_queries, model_queries
    from medlattice.plans.registry import Fixture

    fx = Fixture(spark, "/root/testdata/sf0.001")
    for df in (model_queries._feature_vectors(fx), model_queries._patient_vectors(fx), model_queries._bag_samples(fx), metric_queries._scored(fx)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
        assert "Join" not in plan and "InMemoryRelation" not in plan and df.count() > 0
