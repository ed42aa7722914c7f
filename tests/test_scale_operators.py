"""Operators for data that no single task can hold, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from medlattice.operators import models, quantiles, similarity, trees
from medlattice.session import written
from medlattice.streaming import kmeans as sk


def _sets(rows):
    out = {}
    for p, c in rows:
        if p is not None and c is not None:
            out.setdefault(p, set()).add(c)
    return out


def _classes(sets):
    by = {}
    for p, s in sorted(sets.items()):
        by.setdefault(frozenset(s), []).append(p)
    return {members[0]: (s, len(members)) for s, members in by.items()}


@pytest.mark.parametrize("threshold", [(1, 1), (4, 5), (1, 2), (1, 7)])
@pytest.mark.parametrize("salt", [3, 10_000])
def test_similar_classes(spark, threshold, salt):
    """Copies, a code that all have, sets within and beside the threshold, nulls and repeated rows."""
    rng = np.random.default_rng(4)
    rows = [(p, "everyone") for p in range(60)] + [(p, f"c{rng.integers(12)}") for p in range(60) for _ in range(rng.integers(1, 7))]
    rows += [(100 + p, c) for p in range(25) for c in ("everyone", "c1", "c2")] + [(200, None), (None, "c1"), (3, "c3"), (3, "c3"), (201, "only")]
    df = spark.createDataFrame(rows, "patient_id long, code string")
    members, classes = similarity.set_classes(df, code_cols=("code",))
    want = _classes(_sets(rows))
    assert {(r.patient_id, r.class_id) for r in members.collect()} == {(p, c) for c, (s, _) in want.items() for p, own in _sets(rows).items() if own == s}
    got = similarity.similar_classes(classes, threshold, salt_target=salt).collect()
    num, den = threshold
    pairs = {(a, b, want[a][1], want[b][1], len(want[a][0] & want[b][0]) / len(want[a][0] | want[b][0])) for a in want for b in want
             if a < b and den * len(want[a][0] & want[b][0]) >= num * len(want[a][0] | want[b][0])}
    assert sorted(map(tuple, got)) == sorted(pairs) and len(got) == len(pairs)


def test_common_code_makes_no_pairs(spark):
    """2000 sets of one common and two own codes: not one candidate pair, as the common code is in no indexed prefix."""
    df = spark.range(2000).select(F.col("id").alias("patient_id"), F.explode(F.array(F.lit("all"), F.concat(F.lit("a"), "id"), F.concat(F.lit("b"), "id"))).alias("code"))
    _, classes = similarity.set_classes(df, code_cols=("code",))
    assert classes.count() == 2000 and similarity.similar_classes(classes, (1, 2)).count() == 0
    with pytest.raises(ValueError):
        similarity.similar_classes(classes, (3, 2))


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_exact_percentiles(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(("a", "b", None)[rng.integers(3)], float(rng.integers(40)) / 4 if rng.random() > 0.1 else None) for _ in range(3000)] + [("one", 2.5), ("none", None)]
    shares = {"lo": 0.0, "q": 0.3, "mid": 0.5, "hi": 1.0}
    got = {r.g: r for r in quantiles.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", shares, parts).collect()}
    for g in ("a", "b", None, "one"):
        own = [v for k, v in rows if k == g and v is not None]
        assert [got[g][n] for n in shares] == pytest.approx([float(np.quantile(own, s)) for s in shares.values()], abs=1e-12)
    assert set(got) == {"a", "b", None, "one", "none"} and got["none"].mid is None


def _brute_tree(x, y, depth=0):
    """(depth, n, positives, feature, threshold) of every node of a tree on all values."""
    n, p = len(y), int(sum(y))
    best = None
    if 0 < p < n:
        for f in range(len(x[0])):
            for cut in sorted({r[f] for r in x})[:-1]:
                left = [v for r, v in zip(x, y) if r[f] <= cut]
                nl, pl = len(left), sum(left)
                g = pl * (nl - pl) / nl + (p - pl) * ((n - nl) - (p - pl)) / (n - nl)
                if best is None or (g, f, cut) < best:
                    best = (g, f, cut)
    if best is None:
        return [(depth, n, p, None, None)]
    _, f, cut = best
    side = [r[f] <= cut for r in x]
    out = [(depth, n, p, f, cut)]
    for want in (True, False):
        out += _brute_tree([r for r, s in zip(x, side) if s == want], [v for v, s in zip(y, side) if s == want], depth + 1)
    return out


def test_tree_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, size=(80, 3)).astype(float).tolist()
    y = [int((r[0] + r[1] * r[2]) % 3 == 0) for r in x]
    df = spark.createDataFrame([(i, r, v) for i, (r, v) in enumerate(zip(x, y))] + [(90, None, 1), (91, [1.0, None, 2.0], 1), (92, [1.0, 1.0, 1.0], None)],
                               "id long, features array<double>, label int")
    nodes = written(trees.grow_tree(df), "nodes")
    order = lambda t: tuple((v is None, v) for v in t)
    assert sorted((tuple(r) for r in nodes.select("depth", "n", "positives", "feature", "threshold").collect()), key=order) == sorted(_brute_tree(x, y), key=order)
    got = {r.id: r for r in trees.tree_predictions(nodes, df.where("id < 80"), "id").collect()}
    same = {tuple(r): [v for q, v in zip(x, y) if q == r] for r in x}
    assert all(got[i].probability == pytest.approx(np.mean(same[tuple(r)])) for i, r in enumerate(x) if len(set(same[tuple(r)])) == 1) and len(got) == 80
    assert trees.grow_tree(df, max_depth=0).count() == 1


def test_tree_deeper_than_thirty(spark):
    """Labels in turn along one feature, of growing weight, so that each level cuts off one value."""
    rows = [(float(i), i % 2) for i in range(36) for _ in range(int(3 * 1.15 ** i) + 1)]
    df = spark.createDataFrame([(i, [v], y) for i, (v, y) in enumerate(rows)], "id long, features array<double>, label int")
    nodes = written(trees.grow_tree(df, max_bins=1024), "nodes")
    brute = _brute_tree([[v] for v, _ in rows], [y for _, y in rows])
    assert nodes.count() == len(brute) and max(t[0] for t in brute) == 35 and nodes.agg(F.max("depth")).first()[0] == max(t[0] for t in brute)
    got = trees.tree_predictions(nodes, df, "id").join(df, "id")
    assert got.where("prediction != label").count() == 0 and got.count() == len(rows)
    with pytest.raises(ValueError):
        models.decision_tree(df, max_depth=31)


@pytest.mark.parametrize("few", [0, 7, 60])
def test_tree_leaves_the_levels_at_few_rows(spark, monkeypatch, few):
    """The same tree wherever nodes leave the levels; levels stop when all have."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, size=(120, 3)).astype(float).tolist()
    y = [int(v) for v in rng.integers(0, 2, 120)]
    df = spark.createDataFrame([(i, r, v) for i, (r, v) in enumerate(zip(x, y))], "id long, features array<double>, label int")
    levels, plain = [], trees.written
    monkeypatch.setattr(trees, "written", lambda t, name: levels.append(name) or plain(t, name))
    nodes = plain(trees.grow_tree(df, few=few), "nodes")
    brute, order = _brute_tree(x, y), lambda t: tuple((v is None, v) for v in t)
    assert sorted((tuple(r) for r in nodes.select("depth", "n", "positives", "feature", "threshold").collect()), key=order) == sorted(brute, key=order)
    assert levels.count("tree-level") == 1 + max((t[0] + 1 for t in brute if t[1] > few and t[3] is not None), default=0)
    monkeypatch.setattr(trees, "written", plain)
    ends = trees.tree_predictions(nodes, df, "id")
    assert ends.count() == 120 and plain(trees.grow_tree(df, max_depth=2, few=few), "nodes").agg(F.max("depth")).first()[0] == 2


def _update(centers, weights, points, decay, unit):
    a = decay if unit == "batches" else decay ** len(points)
    near = [int(np.argmin([((p - c) ** 2).sum() for c in centers])) for p in points]
    w = [v * a for v in weights]
    out = []
    for k, c in enumerate(centers):
        own = [p for p, n in zip(points, near) if n == k]
        out.append((c * w[k] + sum(own)) / (w[k] + len(own)) if own else c)
        w[k] += len(own)
    big, low = int(np.argmax(w)), int(np.argmin(w))
    if w[low] < 1e-8 * w[big]:
        half, c = (w[big] + w[low]) / 2, out[big]
        w[big] = w[low] = half
        step = 1e-14 * np.maximum(np.abs(c), 1)
        out[big], out[low] = c + step, c - step
    return out, w


@pytest.mark.parametrize("unit,decay", [("batches", 1.0), ("batches", 0.001), ("points", 0.9)])
def test_kmeans_updates_over_batches(spark, unit, decay):
    """Several batches; with strong decay a cluster without points dies and the largest one is split, both ways of counting time."""
    rng = np.random.default_rng(9)
    centers, weights = [np.array([0.0, 0.0]), np.array([5.0, 5.0]), np.array([90.0, 90.0])], [0.5, 0.5, 0.5]
    table = spark.createDataFrame([(i, c.tolist(), w) for i, (c, w) in enumerate(zip(centers, weights))], "cluster int, center array<double>, weight double")
    split = False
    for _ in range(4):
        points = rng.normal(size=(40, 2)) + rng.choice([0.0, 5.0], size=(40, 1))
        df = spark.createDataFrame([(p.tolist(),) for p in points], "x array<double>").repartition(3)
        table = models.streaming_kmeans_update(table, df, decay, unit=unit).checkpoint()
        centers, weights = _update(centers, weights, points, decay, unit)
        got = {r.cluster: r for r in table.collect()}
        assert [got[i].weight for i in range(3)] == pytest.approx(weights)
        # the halves of a split center differ by less than sums in another order do: compare them, and begin again from the same place
        assert np.allclose([got[i].center for i in range(3)], centers, atol=1e-9)
        centers, weights = [np.array(got[i].center) for i in range(3)], [got[i].weight for i in range(3)]
        split = split or len({round(w, 9) for w in weights}) < 3
    assert split == (decay < 1) and got[2].center != [90.0, 90.0] if decay < 1 else got[2].center == [90.0, 90.0]


@pytest.fixture
def stream_of(spark, tmp_path):
    src = str(tmp_path / "points")

    def add(points):
        spark.createDataFrame([(p,) for p in points], "x array<double>").coalesce(1).write.mode("append").parquet(src)
        return spark.readStream.schema("x array<double>").option("maxFilesPerTrigger", 1).parquet(src)

    return add


def _centers(spark, state):
    return {r.cluster: (r.weight, r.center) for r in sk.latest_centers(spark, state).collect()}


def test_stream_restart(spark, tmp_path, stream_of):
    """Stopped after one file and started again with the second: as the updates by hand, and the initial centers do not come back."""
    init = spark.createDataFrame([(0, [0.0, 0.0], 0.5), (1, [10.0, 10.0], 0.5)], "cluster int, center array<double>, weight double")
    work = str(tmp_path / "work")
    one, two = [[0.0, 1.0], [1.0, 1.0], [9.0, 9.5]], [[11.0, 10.0], [0.5, 0.0]]
    state, last = sk.run_streaming_kmeans(spark, stream_of(one), init, 0.5, work_dir=work)
    assert last == 0
    other = spark.createDataFrame([(0, [7.0, 7.0], 9.0), (1, [8.0, 8.0], 9.0)], init.schema)
    assert sk.run_streaming_kmeans(spark, stream_of(two), other, 0.5, work_dir=work) == (state, 1)
    c, w = [np.array([0.0, 0.0]), np.array([10.0, 10.0])], [0.5, 0.5]
    for points in (one, two):
        c, w = _update(c, w, np.array(points), 0.5, "batches")
    got = _centers(spark, state)
    assert [got[i][0] for i in (0, 1)] == pytest.approx(w) and np.allclose([got[i][1] for i in (0, 1)], c)
    assert sk.run_streaming_kmeans(spark, stream_of(one), other, 0.5, work_dir=work)[1] == 2


def test_stream_replay_and_gap(spark, tmp_path, stream_of):
    """A committed batch that Spark replays is counted once; a batch after a lost one raises; so does another checkpoint."""
    import os
    import shutil

    from pyspark.errors import StreamingQueryException

    init = spark.createDataFrame([(0, [0.0], 0.5), (1, [10.0], 0.5)], "cluster int, center array<double>, weight double")
    work = str(tmp_path / "work")
    state, _ = sk.run_streaming_kmeans(spark, stream_of([[1.0], [9.0]]), init, work_dir=work)
    before = _centers(spark, state)
    os.remove(f"{work}/checkpoint/commits/0")  # as if the driver had been lost between the two commits
    for f in os.listdir(f"{work}/checkpoint/commits"):
        if f.startswith(".0"):
            os.remove(f"{work}/checkpoint/commits/{f}")
    sk.run_streaming_kmeans(spark, stream_of([[2.0]]), init, work_dir=work)
    after = _centers(spark, state)
    assert after[0][0] == before[0][0] + 1 and after[1] == before[1]
    newest = max(sk.committed_batches(spark, state))
    os.remove(f"{state}/commits/batch-{newest}.json")
    with pytest.raises(StreamingQueryException, match="never committed"):
        sk.run_streaming_kmeans(spark, stream_of([[3.0]]), init, work_dir=work)
    shutil.move(f"{work}/checkpoint", f"{work}/lost")
    with pytest.raises(RuntimeError, match="checkpoint that is gone"):
        sk.run_streaming_kmeans(spark, stream_of([[4.0]]), init, work_dir=work)
    with pytest.raises(RuntimeError, match="not committed"):
        sk.latest_centers(spark, state, 99)


def test_unlimited_tree_fits_its_rows(spark):
    import __spark_entry__ as E

    out = E.queries()["unlimited_tree_predictions"](spark, "/root/testdata/sf0.001")
    assert out.where("prediction = label").count() == out.count() > 0


@pytest.mark.parametrize("threshold", [(1, 20), (1, 7), (1, 3), (1, 2)])
@pytest.mark.parametrize("rare", [1, 5, 64])
def test_similar_classes_by_counts(spark, threshold, rare):
    """Rare codes are counted, common ones go by prefixes: the same pairs wherever the line between them is."""
    rng = np.random.default_rng(8)
    rows = [(p, f"c{min(rng.integers(40), rng.integers(40))}") for p in range(70) for _ in range(rng.integers(1, 15))]
    df = spark.createDataFrame(rows, "patient_id long, code string")
    _, classes = similarity.set_classes(df, code_cols=("code",))
    want, (num, den) = _classes(_sets(rows)), threshold
    pairs = {(a, b, want[a][1], want[b][1], len(want[a][0] & want[b][0]) / len(want[a][0] | want[b][0])) for a in want for b in want
             if a < b and den * len(want[a][0] & want[b][0]) >= num * len(want[a][0] | want[b][0])}
    got = similarity.similar_classes(classes, threshold, salt_target=4, rare=rare).collect()
    assert sorted(map(tuple, got)) == sorted(pairs) and len(got) == len(pairs)


def test_low_threshold_moves_no_sets(spark):
    """Sets of rare codes are decided by counts alone: the plan has no whole set in a join."""
    df = spark.range(300).select((F.col("id") % 30).alias("patient_id"), F.concat(F.lit("c"), F.pmod(F.hash("id"), F.lit(50))).alias("code"))
    _, classes = similarity.set_classes(df, code_cols=("code",))
    plan = similarity.similar_classes(classes, (1, 20))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan
