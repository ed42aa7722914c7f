import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from medlattice.operators import graph, walk

D = dt.date


def _toy(spark):
    patients = spark.createDataFrame([(1,), (2,), (3,), (4,)], "patient_id long")  # 4 has no codes
    recs = spark.createDataFrame([
        (1, "diagnostic", "x", D(2000, 1, 1), 1.0, 1, 1), (1, "diagnostic", "x", D(2000, 2, 1), 5.0, 2, 1),
        (1, "lab", "y", D(2000, 1, 1), 2.0, 1, 2), (2, "diagnostic", "x", D(2000, 1, 1), 3.0, 3, 1),
        (2, "medication", "z", D(2000, 1, 1), 0.0, 3, 2), (3, "medication", "z", D(2000, 1, 1), 0.0, 4, 1),
    ], "patient_id long, kind string, code string, date date, value double, encounter_id long, linenumber int")
    return graph.build_graph(patients, recs)


def test_build_graph(spark):
    v, e = _toy(spark)
    assert v.count() == 4 + 3
    assert e.count() == 2 * 5
    latest = e.where((F.col("src") == 1) & (F.col("kind") == "diagnostic")).first()
    assert latest.value == 5.0 and latest.date == D(2000, 2, 1)
    assert v.where(F.col("vertex_id") < 0).select(F.min("vertex_id")).first()[0] == -3


def test_jaccard(spark):
    v, e = _toy(spark)
    pairs = graph.patient_code_pairs(e)
    allp = {(r.p1, r.p2): r.similarity for r in graph.jaccard_all_pairs(pairs).collect()}
    assert allp == {(1, 2): 1 / 3, (2, 3): 0.5}
    pats = v.where(F.col("kind") == "patient").select(F.col("vertex_id").alias("patient_id"))
    top = [(r.patient_id, r.similarity) for r in graph.jaccard_one_vs_all(pairs, pats, 2, k=10).collect()]
    assert top == [(3, 0.5), (1, 1 / 3), (4, 0.0)]
    row = spark.createDataFrame([([1, 2], [2, 3]), ([], [])], "a array<int>, b array<int>")
    assert [r[0] for r in row.select(graph.jaccard("a", "b")).collect()] == [1 / 3, 0.0]


def test_salted_pairs_equal_plain(spark):
    # one hot code held by every patient, salted into many buckets
    rows = [(p, -1) for p in range(60)] + [(p, -2 - (p % 3)) for p in range(60)]
    pairs = spark.createDataFrame(rows, "patient_id long, code_id long")
    a = {(r.p1, r.p2): r.similarity for r in graph.jaccard_all_pairs(pairs, salt_target=7).collect()}
    b = {(r.p1, r.p2): r.similarity for r in graph.jaccard_all_pairs(pairs, salt_target=10_000).collect()}
    assert len(a) == 60 * 59 // 2 and a == b


def _brute_walk(v_ids, edges, source, rounds, alpha):
    idx = {x: i for i, x in enumerate(v_ids)}
    n = len(v_ids)
    outdeg = {}
    for s, _ in edges:
        outdeg[s] = outdeg.get(s, 0) + 1
    r = np.zeros(n)
    r[idx[source]] = alpha
    has_in = {d for _, d in edges}
    for _ in range(rounds):
        msg = np.zeros(n)
        for s, d in edges:
            msg[idx[d]] += r[idx[s]] / outdeg[s]
        new = r.copy()
        for vtx in has_in:
            i = idx[vtx]
            new[i] = (1 - alpha) * msg[i] + (alpha if vtx == source else 0.0)
        r = new
    return {x: r[idx[x]] for x in v_ids}


def test_random_walk_matches_brute_force(spark):
    v, e = _toy(spark)
    ids = [r.vertex_id for r in v.collect()]
    edges = [(r.src, r.dst) for r in e.collect()]
    for rounds in (1, 3, 9):
        got = {r.vertex_id: r.rank for r in graph.random_walk(v, e, 1, rounds, 0.15, checkpoint_every=2).collect()}
        want = _brute_walk(ids, edges, 1, rounds, 0.15)
        assert all(abs(got[k] - want[k]) < 1e-12 for k in ids)
        assert all(x >= 0 for x in got.values())
        salted = {r.vertex_id: r.rank for r in graph.random_walk(v, e, 1, rounds, 0.15, checkpoint_every=2,
                                                                 salt_target=1).collect()}
        assert all(abs(salted[k] - want[k]) < 1e-12 for k in ids)
    ranked = graph.random_walk_one_vs_all(v, e, 1, 5).orderBy("position").collect()
    assert [r.position for r in ranked] == [1, 2, 3] and 1 not in [r.patient_id for r in ranked]


def test_shared_counts_against_brute_force(spark):
    """Codes in one list and in several, nulls, a key without a partner."""
    rng = np.random.default_rng(2)
    sets = {p: {int(c) for c in rng.integers(0, 9, rng.integers(1, 6))} for p in range(40)} | {99: {77}}
    rows = [(p, c) for p, own in sets.items() for c in own] + [(None, 1), (5, None)]
    df = spark.createDataFrame(rows, "k long, code long").repartition(5)
    want = sorted((a, b, len(sets[a] & sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b])
    for target in (1, 3, 1000):
        assert sorted(map(tuple, graph.shared_counts(df, "k", ["code"], target).collect())) == want


def test_power_iteration_clusters_without_graphx(spark):
    """Two groups joined by a weak pair come apart, the same at every run and layout; an empty table gives no rows."""
    rows = [(a, b, 1.0) for g in (range(8), range(20, 28)) for a in g for b in g if a < b] + [(0, 20, 0.01), (3, 3, 5.0), (None, 2, 1.0)]
    df = spark.createDataFrame(rows, "p1 long, p2 long, similarity double")
    runs = [sorted(map(tuple, graph.power_iteration_clusters(df.repartition(n), k=2, max_iter=20).collect())) for n in (1, 5)]
    got = dict(runs[0])
    assert runs[0] == runs[1] and set(got) == {*range(8), *range(20, 28)}
    assert len({got[i] for i in range(8)}) == len({got[i] for i in range(20, 28)}) == 1 and got[0] != got[20]
    assert graph.power_iteration_clusters(df.limit(0), k=2).count() == 0


def test_edges_read_records_once(spark):
    _, e = _toy(spark)
    assert e._jdf.queryExecution().optimizedPlan().toString().count("max_by") == 1


def test_walk_between_sides(spark):
    """The far side's ranks are never shuffled: every number of rounds and both sides as the source equal brute force; other graphs take the general way."""
    rng = np.random.default_rng(4)
    both = [(p, -c) for p in range(1, 9) for c in range(1, 7) if rng.random() < 0.5]
    edges = [*both, *[(c, p) for p, c in both if rng.random() < 0.8]]
    ids = [*range(10), *range(-7, 0)]
    v = spark.createDataFrame([(i, "x") for i in ids], "vertex_id long, kind string")
    for source, rounds in ((3, 0), (3, 1), (3, 4), (-2, 5), (9, 2)):
        df = spark.createDataFrame(edges, "src long, dst long")
        got = {r.vid: r.rank for r in graph._walk_between_sides(v, df, source, rounds, 0.2, 100).collect()}
        want = _brute_walk(ids, edges, source, rounds, 0.2)
        assert all(abs(got.get(k, 0.0) - want[k]) < 1e-12 for k in ids) and set(got) <= set(ids)
    assert graph._walk_between_sides(v, df, 3, 4, 0.2, 1) is None  # hot codes
    mixed = [*edges, (1, 2), (2, 9)]
    got = {r.vertex_id: r.rank for r in graph.random_walk(v, spark.createDataFrame(mixed, "src long, dst long"), 3, 4, 0.2).collect()}
    want = _brute_walk(ids, mixed, 3, 4, 0.2)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in ids)


def test_shared_counts_far_apart_keys(spark):
    """Keys whose range is beyond an int are counted as well; close ones are shuffled as ints."""
    for keys, kind in (((1 << 40, (1 << 40) + 5), "int"), ((-(1 << 62), 1 << 62), "bigint")):
        df = spark.createDataFrame([(k, c) for k in keys for c in (1, 2)], "k long, code long")
        out = graph.shared_counts(df, "k", ["code"])
        assert [tuple(r) for r in out.collect()] == [(*keys, 2)] and dict(out.dtypes)["p1"] == "bigint"
        assert ("cast(p1#" in out._jdf.queryExecution().optimizedPlan().toString()) == (kind == "int")


def test_walk_writes_nothing_per_round(spark, monkeypatch):
    """More rounds do not write more tables: the near ranks go out and back as one array."""
    v, e = _toy(spark)
    labels, write = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, label: labels.append(label) or write(df, label))
    tables = []
    for rounds in (2, 12):
        labels.clear()
        got = {r.vertex_id: r.rank for r in graph.random_walk(v, e, 1, rounds, 0.15).collect()}
        tables.append(sorted(labels))
        want = _brute_walk(list(got), [(r.src, r.dst) for r in e.collect()], 1, rounds, 0.15)
        assert all(abs(got[k] - want[k]) < 1e-12 for k in got)
    assert tables[0] == tables[1]


def test_walk_blocks(spark, monkeypatch):
    """Small blocks, repeated edges, null ends (which take their share nowhere) and a source that is no vertex give the ranks of plain sums."""
    rng = np.random.default_rng(5)
    both = [(int(p), -int(c)) for p, c in zip(rng.integers(0, 30, 150), rng.integers(1, 40, 150), strict=True)]
    edges = [*both, *[(c, p) for p, c in both if rng.random() < 0.9], (3, None), (-5, None), (-5, None), (None, -6), (None, 4), (None, None)]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(3)
    v = spark.createDataFrame([(i,) for i in [*range(31), *range(-40, 0)]], "vertex_id long")
    deg = {}
    for s, _ in edges:
        deg[s] = deg.get(s, 0) + 1
    monkeypatch.setattr(walk, "CHUNK", 8)
    for most, rounds, source in ((7, 6, 3), (40, 7, 3), (2_000_000, 1, 3), (20, 4, 99)):
        monkeypatch.setattr(walk, "BLOCK_EDGES", most)
        monkeypatch.setattr(walk, "PARTITION_EDGES", 3 * most)
        start = {3: 0.2, 99: 0.0}[source]
        want = {source: start}
        for _ in range(rounds):
            new = {source: start}
            for s, d in edges:
                if s is not None and d is not None and s in want:
                    new[d] = new.get(d, 0.0) + 0.8 * want[s] / deg[s]
            want = new
        got = {r.vid: r.rank for r in graph._walk_between_sides(v, df, source, rounds, 0.2, 100).collect()}
        assert all(abs(got.get(k, 0.0) - want.get(k, 0.0)) < 1e-12 for k in {*got, *want}), (most, rounds, source)
    ids = type("Shared", (), {"value": np.arange(30)})
    far = np.repeat([-9, -8, -7], [3, 90, 5])
    table = [pa.record_batch([pa.array(x[i:i + 4]) for x in (far, np.arange(98) % 30, np.zeros(98, np.int8))], ["far", "vid", "way"]) for i in range(0, 98, 4)]
    assert [r.column("most")[0].as_py() for r in walk.blocks_task(ids, 10, 90)(iter(table))] == [3, 90, 5]
    hot = [*walk.blocks_task(ids, 10, 50)(iter(table))]
    assert hot[-1].column("far")[0].as_py() is None and hot[-1].column("most")[0].as_py() > 50  # what is left is not kept


def test_large_code_index_is_hashed(spark, monkeypatch):
    """A code index that is too large to be broadcast is the hashed side: the pairs are not sorted by code. The edges stay the same."""
    want = sorted((r.src, r.dst, r.kind, r.value) for r in _toy(spark)[1].collect())
    monkeypatch.setattr(graph, "proven_small", lambda df, *_: False)
    e = _toy(spark)[1]
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r.src, r.dst, r.kind, r.value) for r in e.collect()) == want
