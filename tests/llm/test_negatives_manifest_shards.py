"""Hard negatives, Merkle manifest and sharding against brute force."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

pytest.importorskip("medlattice.llm")

from pyspark.sql import functions as F  # noqa: E402

from medlattice.llm import hard_negatives, merkle, shards  # noqa: E402
from medlattice.llm.queries import ORACLES, QUERIES  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, label string, slot int, score string, id string"
DOCS = "doc_id long, text string, source string, path string, subroot string, shard string, slot string"


def _mined(rows, anchor, positives, negatives, low, high):
    """Every pair compared; the best of each window by a sort."""
    rows = sorted({(i, lab, tuple(int(np.floor(256 * x)) for x in v)) for i, v, lab in rows
                   if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    out = []
    for a, lab, v in rows:
        if not anchor(a):
            continue
        scored = sorted({(-sum(x * y for x, y in zip(v, w)), i, k == lab) for i, k, w in rows if i != a})
        same = [(-s, i) for s, i, mine in scored if mine][:positives]
        other = [(-s, i) for s, i, mine in scored if not mine]
        for ps, p in same:
            window = [(s, i) for s, i in other if low * ps <= 100 * s <= high * ps][:negatives]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("seed,most", [(0, 1 << 14), (1, 7)])
def test_hard_negatives_brute_force(spark, monkeypatch, seed, most):
    """Ties, repeated rows and ids, negative scores, nulls, non-finite and short vectors; one and several groups of anchors."""
    monkeypatch.setattr(hard_negatives, "MOST_ANCHORS", most)
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) / 256 for x in rng.integers(-2, 4, size=3)], "abc"[rng.integers(3)]) for i in range(300)]
    rows += [rows[4], (7, [1.0, 1.0, 1.0], "a"), (None, [1.0, 1.0, 1.0], "a"), (400, None, "a"), (410, [1.0, None, 0.0], "b"),
             (420, [float("nan"), 1.0, 1.0], "b"), (430, [float("inf"), 1.0, 1.0], "b"), (440, [0.01, 0.02], "b"), (450, [], "c"), (460, [0.01, 0.0, 0.0], None)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], VECTORS).repartition(5)
    got = hard_negatives.mine_hard_negatives(df, F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == _mined(rows, lambda i: i % 10 == 0, 5, 3, 50, 95)


def test_hard_negatives_without_rows(spark):
    df = spark.createDataFrame([(1, [1.0], "a", 1, "x", "y")], VECTORS)
    assert hard_negatives.mine_hard_negatives(df, F.col("id") == 2).count() == 0
    assert hard_negatives.mine_hard_negatives(df.limit(0), F.col("id") == 1).count() == 0
    assert hard_negatives.mine_hard_negatives(df, F.col("id") == 1).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_inner_products_are_exact():
    a, b = np.array([[2.0 ** 40, 3.0]]), np.array([[2.0 ** 20, 1.0, 9.0]])
    assert hard_negatives.inner_products(a, b).tolist() == [[2 ** 60 + 3]]
    with pytest.raises(OverflowError):
        hard_negatives.inner_products(np.array([[2.0 ** 40]]), np.array([[2.0 ** 40]]))


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """(root, siblings of each leaf by level as (left, right))."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // 3 * 3
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1:run + 3])))
            at[i] = p // 3
        level = [_h(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def _field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_merkle_brute_force(spark, monkeypatch, levels):
    """Groups from one leaf to hundreds, null and clashing columns, repeated rows; small blocks recurse several times."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    rows = [(i, f"text\n{i} é", "big", None, "s", None, "x") for i in range(280)] + [(1000 + i, None if i % 3 else "", None, "p", "s", "a", "x") for i in range(10)]
    rows += [(2000 + i, "t", s, "p", None, "a", None) for i, s in enumerate(["one", "", "zz", "Ünï", "one", "日本"])]
    rows += [(None, "no id", "one", "p", "s", "a", "x"), (2000, "t", "one", "p", None, "a", None), (2000, "other", "one", "p", None, "a", None)]
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    leaf = merkle.leaf_hash(F.col("doc_id"), F.col("text"))
    manifest = merkle.build_manifest(df.withColumn("leaf", leaf).withColumn("odd", merkle.leaf_hash(F.col("doc_id"), F.replace("text", F.lit("\n"), F.lit("")))))
    out = manifest.proofs()
    assert "shard" in out.columns and out.columns.count("path") == 1 and out.columns.count("subroot") == 1
    got = out.select("doc_id", "source", "leaf", "subroot", "root", merkle.siblings(F.col("path")).alias("p"), merkle.fold(F.col("leaf"), F.col("path")).alias("same"),
                     merkle.fold(F.col("odd"), F.col("path")).alias("other")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, _h(_field(r[0]), _field(r[1]))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, over = _tree([trees[s][0] for s in order])
    want = Counter()
    for s, above in zip(order, over):
        for (known, i, h), path in zip(sorted(groups[s]), trees[s][1]):
            want[(i if known else None, s, h, trees[s][0], root, "".join(x + y for x, y in path + above))] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(r.same == root for r in got)
    for r in got:  # only the leaves whose text has changed no longer give the root
        assert (r.other != root) == (r.source == "big")
    subs = manifest.subroots.orderBy("place").collect()
    assert [(r.source, r.subroot) for r in subs] == [(s, trees[s][0]) for s in order] and manifest.root.first().root == root


def test_merkle_without_rows(spark):
    df = spark.createDataFrame([], DOCS).withColumn("leaf", F.lit("x"))
    assert merkle.build_manifest(df).proofs().count() == 0


def _shard_rows(spark):
    rows = [(i, "word " * (i % 17), "s", None, None, "clash", "clash") for i in range(500)] + [(None, None, None, None, None, None, None)] * 3
    rows += [(9, "copy " * 30, "s", None, None, "a", "b")] * 250 + [(9, "", "s", None, None, "a", "b"), (9, None, "s", None, None, "a", "b"), (501, "long " * 20000, "s", None, None, "a", "b")]
    return rows, spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("size", [2000, 1 << 24])
def test_shards(spark, size):
    """Counts at most one apart, gapless slots, no row lost; a third of the rows repeat one record, whose bucket is dealt again."""
    rows, df = _shard_rows(spark)
    out = shards.write_shards(df, shards=6, bucket_bytes=size)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "source", "path", "subroot", "shard", "slot"]
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(6)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(counts[s])) for s in counts)


def test_shards_follow_the_two_passes(spark):
    """Places as a plain scatter and Fisher-Yates of each bucket give them, however the input is partitioned."""
    df = spark.createDataFrame([(i, f"t{i % 7}", None, None, None, None, None) for i in range(1000)], DOCS)
    total = 1000 * 66
    count = -(-total // 4000)
    keyed = df.select("doc_id", F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), F.lit(count)).alias("b"), F.xxhash64(F.lit(6), "doc_id", "text").alias("o")).collect()
    order = []
    for b in range(count):
        own = [r.doc_id for r in sorted((r for r in keyed if r.b == b), key=lambda r: r.o)]
        order += [own[i] for i in np.random.Generator(np.random.PCG64([5, b])).permutation(len(own))]
    want = {i: (p * 4 // 1000, p % 250) for p, i in enumerate(order)}
    for parts in (1, 9):
        out = shards.write_shards(df.repartition(parts, F.rand(parts)), shards=4, seed=5, bucket_bytes=4000)
        assert {r.doc_id: (r.shard, r.slot) for r in out.collect()} == want
        in_file = out.withColumn("f", F.input_file_name()).withColumn("m", F.monotonically_increasing_id()).collect()
        for f in {r.f for r in in_file}:  # a file's rows are in slot order
            assert [r.slot for r in sorted((r for r in in_file if r.f == f), key=lambda r: r.m)] == sorted(r.slot for r in in_file if r.f == f)


def test_shards_without_rows(spark):
    out = shards.write_shards(spark.createDataFrame([], DOCS))
    assert out.count() == 0 and out.columns[-2:] == ["shard", "slot"]


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle_manifest"])
def test_registered_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, folder).toPandas()
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(map(tuple, got[columns].values.tolist())) == sorted(map(tuple, want[columns].values.tolist())) and len(got)
