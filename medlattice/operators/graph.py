"""Patient-code graph: construction, Jaccard similarity, random walk with
restart and power-iteration clustering, as DataFrame jobs.

Graph representation:
* vertices: vertex_id (long), kind ('patient' | record kind), key (text)
  Patients keep their id; code vertices get -1, -2, ... in (kind, key)
  order, so ids never collide (typed keys, no offset arithmetic).
* edges: src, dst, kind, date, value: one pair of directed edges per
  distinct (patient, kind, code), carrying that pair's latest record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalars import safe_ratio
from medlattice.operators import walk
from medlattice.operators.indexing import dense_index
from medlattice.session import DEFAULT_BROADCAST_BYTES, maybe_broadcast, proven_small, written

PATIENT = "patient"
# Keys of one code in one list of the all-pairs count.
SALT_TARGET = 2048
# Out-edges of one vertex per (vertex, salt) partition key in the random walk.
EDGE_SALT_TARGET = 100_000
# Cached weighted edges per partition in the random-walk loop (measured: ~150k
# edges per task balances per-round task overhead and parallelism).
EDGES_PER_PARTITION = 150_000


def jaccard(a: Column | str, b: Column | str) -> Column:
    """|a ∩ b| / |a ∪ b| of two arrays; 0 when both are empty."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return safe_ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def jaccard_of_counts(shared: Column | str, n1: Column | str, n2: Column | str) -> Column:
    """G2 of two sets of n1 and n2 elements that share ``shared``."""
    shared, n1, n2 = (F.col(c) if isinstance(c, str) else c for c in (shared, n1, n2))
    return safe_ratio(shared, n1 + n2 - shared)


def build_graph(patients: DataFrame, records: DataFrame,
                order_cols: tuple[str, ...] = ("date", "encounter_id", "linenumber"),
                record_cols: tuple[str, ...] = ("date", "value")) -> tuple[DataFrame, DataFrame]:
    """G1: (vertices, edges) from patients (patient_id) and records
    (patient_id, kind, code, <order_cols>, <record_cols>).

    A15: each (patient, kind, code) keeps its latest record by
    ``order_cols`` (a total order, so the choice is deterministic); the
    ``max_by`` aggregate is partial, so a hot pair is combined map-side.
    """
    code_index = dense_index(records, ["kind", "code"], "_i")
    code_vertices = code_index.select((-1 - F.col("_i")).alias("vertex_id"), "kind", F.col("code").alias("key"))
    patient_vertices = patients.select(
        F.col("patient_id").cast("long").alias("vertex_id"), F.lit(PATIENT).alias("kind"),
        F.col("patient_id").cast("string").alias("key"))
    vertices = patient_vertices.unionByName(code_vertices)

    latest = records.groupBy("patient_id", "kind", "code").agg(
        F.max_by(F.struct(*record_cols), F.struct(*order_cols)).alias("rec"))
    # An index too large to be broadcast is hashed, one row per code: the pairs, which are many more, are not sorted by their codes' text.
    index = F.broadcast(code_index) if proven_small(code_index) else code_index.hint("shuffle_hash")
    pc = (latest.join(index, ["kind", "code"])
          .select(F.col("patient_id").cast("long").alias("p"), (-1 - F.col("_i")).alias("c"), "kind", "rec"))
    # Both directions from one row: a union would aggregate and join the records twice.
    ways = F.array(F.struct(F.col("p").alias("src"), F.col("c").alias("dst")), F.struct(F.col("c").alias("src"), F.col("p").alias("dst")))
    return vertices, pc.select(F.explode(ways).alias("e"), "kind", "rec").select("e.*", "kind", "rec.*")


def patient_code_pairs(edges: DataFrame) -> DataFrame:
    """A17 in long form: patient_id, code_id (patient -> code edges only)."""
    return edges.where(F.col("src") >= 0).select(F.col("src").alias("patient_id"), F.col("dst").alias("code_id"))


def patient_code_keys(records: DataFrame) -> DataFrame:
    """The same adjacency straight from the records: distinct (patient_id,
    kind, code). Similarity jobs need no numeric vertex ids, so they skip
    the vertex index (an ordered numbering of all codes)."""
    return records.select(F.col("patient_id").cast("long").alias("patient_id"), "kind", "code").distinct()


def jaccard_one_vs_all(pairs: DataFrame, patients: DataFrame, patient_id: int, k: int = 10,
                       code_cols: tuple[str, ...] = ("code_id",)) -> DataFrame:
    """The k patients most similar to ``patient_id`` (ties by id).

    Only the query patient's codes are probed in the inverted index;
    patients sharing no code (or with none) score 0 and still compete.
    One pass over the pairs: each row is marked when the query patient has
    its code, and one per-patient aggregate counts both the patient's codes
    and the shared ones.
    """
    code_cols = list(code_cols)
    mine = (pairs.where(F.col("patient_id") == patient_id).select(*code_cols).distinct()
            .withColumn("_hit", F.lit(1)))
    per = (pairs.where(F.col("patient_id") != patient_id)
           .join(maybe_broadcast(mine), code_cols, "left")
           .groupBy("patient_id").agg(F.count("_hit").alias("i"), F.count(F.lit(1)).alias("n")))
    n_p = pairs.where(F.col("patient_id") == patient_id).agg(F.count(F.lit(1)).alias("n_p")).scalar()
    cand = (patients.select("patient_id").where(F.col("patient_id") != patient_id).distinct()
            .join(per, "patient_id", "left")
            .withColumn("n_p", n_p))
    i = F.coalesce("i", F.lit(0))
    n = F.coalesce("n", F.lit(0))
    npp = F.coalesce("n_p", F.lit(0))
    sim = safe_ratio(i, npp + n - i)
    return (cand.select("patient_id", sim.alias("similarity"))
            .orderBy(F.desc(F.round("similarity", 12)), F.asc("patient_id")).limit(k))


def shared_counts(pairs: DataFrame, key: str, code_cols: list[str], salt_target: int = SALT_TARGET) -> DataFrame:
    """(p1, p2, i): how many codes each two keys p1 < p2 share, for every two that share one. ``pairs`` are distinct (key, codes);
    rows with a null take no part.

    Each code's keys become sorted lists of about ``salt_target`` (a hotter code has several, met in pairs). A key p1 is sent, for each of its
    codes, the keys above it as one array, so what is shuffled follows the entries and not the pairs. The arrays are unpacked and
    counted where they arrive: all pairs of a p1 are in one partition, so the pairs themselves are not shuffled.
    """
    code_cols = list(code_cols)
    e = pairs.select(F.col(key).alias("_p"), *code_cols).dropna()
    kind, low = e.schema["_p"].dataType, None
    if kind.typeName() == "long":  # most of what is shuffled are these keys: as ints, if their range allows
        ends = e.agg(F.min("_p").alias("low"), F.max("_p").alias("high")).first()
        if ends.low is not None and ends.high - ends.low < 1 << 31:
            low = ends.low
            e = e.withColumn("_p", (F.col("_p") - F.lit(low)).cast("int"))
    ways = (e.groupBy(*code_cols).agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_target)).alias("_ways")).where(F.col("_ways") > 1))
    block = F.pmod(F.xxhash64("_p"), F.coalesce("_ways", F.lit(1)))
    lists = (e.join(maybe_broadcast(ways), code_cols, "left").withColumn("_b", block)
             .groupBy(*code_cols, "_ways", "_b").agg(F.sort_array(F.collect_list("_p")).alias("_ps")))
    own = (lists.select("_ps", F.posexplode("_ps").alias("_i", "p1"))
           .select("p1", F.expr("slice(_ps, _i + 2, size(_ps))").alias("_others")))
    hot = lists.where(F.col("_ways") > 1)
    two = (hot.select(*code_cols, F.col("_b").alias("_b1"), F.col("_ps").alias("_x"))
           .join(hot.select(*code_cols, F.col("_b").alias("_b2"), F.col("_ps").alias("_y")), code_cols).where("_b1 < _b2"))
    sides = [two.select(F.explode(x).alias("p1"), F.col(y).alias("_o")).select("p1", F.expr("filter(_o, o -> o > p1)").alias("_others"))
             for x, y in (("_x", "_y"), ("_y", "_x"))]
    sent = own.unionByName(sides[0]).unionByName(sides[1]).where(F.size("_others") > 0).repartition("p1")
    counts = sent.select("p1", F.explode("_others").alias("p2")).groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("i"))
    return counts if low is None else counts.select(*[(F.col(c).cast(kind) + F.lit(low).cast(kind)).alias(c) for c in ("p1", "p2")], "i")


def jaccard_all_pairs(pairs: DataFrame, salt_target: int = SALT_TARGET, distinct_input: bool = False,
                      code_cols: tuple[str, ...] = ("code_id",)) -> DataFrame:
    """(p1, p2, similarity) for every pair p1 < p2 sharing a code.

    Pairs with no shared code have similarity 0 and are not materialized (that would be a cross join); see
    :func:`shared_counts` for the others. The distinct entries are written once; each patient's code count, one small row, is joined to
    the counted pairs, by broadcast where its written size allows. Pass ``distinct_input=True`` when pairs are already
    distinct (graph edges are) to skip one shuffle.
    """
    code_cols = list(code_cols)
    e = pairs.select("patient_id", *code_cols)
    if not distinct_input:
        e = e.distinct()
    e = written(e, "patient-codes")
    deg = maybe_broadcast(written(e.dropna(subset=["patient_id"]).groupBy("patient_id").agg(F.count(F.lit(1)).alias("_n")), "code-counts"))
    inter = (shared_counts(e, "patient_id", code_cols, salt_target)
             .join(deg.select(F.col("patient_id").alias("p1"), F.col("_n").alias("n1")), "p1")
             .join(deg.select(F.col("patient_id").alias("p2"), F.col("_n").alias("n2")), "p2"))
    return inter.select("p1", "p2", jaccard_of_counts("i", "n1", "n2").alias("similarity"))


def random_walk(vertices: DataFrame, edges: DataFrame, source: int, num_iter: int = 100,
                alpha: float = 0.15, checkpoint_every: int = 4,
                salt_target: int = EDGE_SALT_TARGET) -> DataFrame:
    """Random walk with restart from ``source``; vertex_id, rank.

    Start: alpha at the source, 0 elsewhere; edge weight 1/outdegree; each
    round r'(v) = [v = source]·alpha + (1 - alpha)·Σ r(u)·w(u, v), and a
    vertex without in-edges keeps its start value (which that formula also
    gives). Only vertices with rank > 0 are stored and send messages.

    The weighted edges are cached once, hash-partitioned by src; the ranks
    leave each round's aggregate hash-partitioned by vertex, so the join
    (a shuffled hash join that builds on the ranks and streams the edges:
    no per-round sort, no broadcast of a side that grows with the graph)
    needs no shuffle and the only per-round shuffle is the message sum
    (partially aggregated). When some vertex has more than ``salt_target``
    out-edges (decided once from the degree table), the edges are instead
    partitioned by (src, salt) with ceil(d / salt_target) salts per vertex,
    so a hot vertex's edges are split over many tasks; the live ranks are
    then fanned out to their vertex's salts and shuffled each round. The
    loop's partition count follows the edge count (capped by the session's
    ``spark.sql.shuffle.partitions``) and is pinned, with AQE off, for the
    loop only so that the message aggregate lands in the edges' layout. Lineage is cut with a reliable
    ``checkpoint`` every few rounds in ``spark.checkpoint.dir`` (measured:
    planning a longer chain costs more than the small checkpoint write).
    AQE is switched off inside the loop only, so the cached edge
    partitioning is kept.

    If every edge goes between vertices below 0 and others (patients and codes, as :func:`build_graph` numbers them), and no vertex on
    the side away from the source is hot, :func:`_walk_between_sides` does the same rounds with far smaller shuffles.
    """
    spark = edges.sparkSession
    edges = written(edges.select("src", "dst"), "walk-edges")  # read several times: the graph would be built each time
    if edges.where((F.col("src") < 0) == (F.col("dst") < 0)).isEmpty():
        ranks = _walk_between_sides(vertices, edges, source, num_iter, alpha, salt_target)
        if ranks is not None:
            return _with_ranks(vertices, ranks)
    outdeg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_deg"))
    n_salts = F.greatest(F.lit(1), F.ceil(F.col("_deg") / F.lit(salt_target))).cast("int")
    # one row from the degree table: is any vertex hot, and how many edges
    # (the loop's partition count follows the edge count, capped by the session)
    max_deg, n_edges = outdeg.agg(F.max("_deg"), F.sum("_deg")).first()
    salted = (max_deg or 0) > salt_target
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
            max(2, -(-(n_edges or 0) // EDGES_PER_PARTITION)))
    w_edges = edges.select("src", "dst").join(outdeg, "src").select(
        "src", F.pmod(F.xxhash64("dst"), n_salts).alias("salt"), "dst", (F.lit(1.0) / F.col("_deg")).alias("w"))
    if salted:
        w_edges = w_edges.repartition(n, "src", "salt").persist()
        salts = outdeg.select(F.col("src").alias("vid"), n_salts.alias("_ns")).repartition(n, "vid").persist()
    else:
        w_edges = w_edges.repartition(n, "src").persist()
        salts = None
    seed = (vertices.where(F.col("vertex_id") == source)
            .select(F.col("vertex_id").alias("vid"), F.lit(0.0).alias("m")).persist())
    ranks = seed.select("vid", F.lit(alpha).alias("rank"))
    prev_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    prev_parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        for it in range(num_iter):
            if salted:
                live = (ranks.where(F.col("rank") > 0).join(salts, "vid")
                        .select("vid", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1)).alias("salt"), "rank")
                        .repartition(n, "vid", "salt").hint("shuffle_hash"))
                cond = (w_edges.src == live.vid) & (w_edges.salt == live.salt)
            else:
                live = ranks.where(F.col("rank") > 0).hint("shuffle_hash")
                cond = w_edges.src == live.vid
            msgs = (w_edges.join(live, cond)
                    .select(F.col("dst").alias("vid"), (F.col("rank") * F.col("w")).alias("m")))
            summed = msgs.unionByName(seed).groupBy("vid").agg(F.sum("m").alias("s"))
            ranks = summed.select(
                "vid", ((1.0 - alpha) * F.col("s")
                        + F.when(F.col("vid") == source, F.lit(alpha)).otherwise(F.lit(0.0))).alias("rank"))
            if (it + 1) % checkpoint_every == 0 and it + 1 < num_iter:
                ranks = ranks.checkpoint(eager=True)
        ranks = ranks.checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev_aqe)
        spark.conf.set("spark.sql.shuffle.partitions", prev_parts)
        w_edges.unpersist()
        if salts is not None:
            salts.unpersist()
        seed.unpersist()
    return _with_ranks(vertices, ranks)


def _with_ranks(vertices: DataFrame, ranks: DataFrame) -> DataFrame:
    return (vertices.select("vertex_id", "kind")
            .join(ranks.withColumnRenamed("vid", "vertex_id"), "vertex_id", "left")
            .select("vertex_id", "kind", F.coalesce("rank", F.lit(0.0)).alias("rank")))


def _walk_between_sides(vertices: DataFrame, edges: DataFrame, source: int, num_iter: int, alpha: float, salt_target: int) -> DataFrame | None:
    """(vid, rank) of :func:`random_walk` where each edge joins the source's side (near) and the other one (far); None if a far vertex is hot or
    the near ranks are too many to be broadcast. Vertices with rank 0 may be left out.

    A side's ranks of a round follow from the other side's of the round before. All far ranks are 0 at the start, so round 1 leaves the near
    ranks as they are, round 2 changes them, and so on: round 2k + 1 gives the near side nothing new, nor round 2k the far side, and two
    rounds are one step from near to near. Both ways' edges are kept in blocks by their far vertex (:mod:`medlattice.operators.walk`): the far ranks
    are made and used inside a block and never shuffled. The near ranks are one array, which goes out to the tasks each step and comes back
    as one partial sum per task.
    """
    spark = edges.sparkSession
    near = (lambda c: F.col(c) >= 0) if source >= 0 else (lambda c: F.col(c) < 0)
    seed = written(vertices.where(F.col("vertex_id") == source).select(F.col("vertex_id").alias("vid"), F.lit(alpha).alias("rank")), "walk-ranks")
    copies = seed.count()
    ends = edges.select(F.when(near("src"), F.col("src")).otherwise(F.col("dst")).cast("long").alias("vid"), near("src").cast("long").alias("out"))
    degrees = written(ends.where(near("vid")).groupBy("vid").agg(F.coalesce(F.sum("out"), F.lit(0)).alias("deg")), "walk-degrees")
    if degrees.count() * 8 > DEFAULT_BROADCAST_BYTES:
        return None
    found = degrees.toArrow()
    vid, deg = (found.column(c).to_numpy() for c in ("vid", "deg"))
    ids = np.union1d(vid, np.array([source], dtype=np.int64))
    degree = np.zeros(len(ids))
    degree[np.searchsorted(ids, vid)] = deg
    own = int(np.searchsorted(ids, source))
    share = lambda x: x / np.maximum(degree, 1.0)
    shared, blocks = spark.sparkContext.broadcast(ids), None
    try:
        blocks = walk.blocks_of(edges, near, shared, int(deg.sum()), salt_target)
        if blocks is None:
            return None
        x, before = np.zeros(len(ids)), None
        x[own] = copies * alpha
        for _ in range(num_iter // 2):
            before, x = x, (1.0 - alpha) * walk.near_step(blocks, share(x), alpha)
            x[own] += alpha if copies else 0.0
        if num_iter < 2:
            ranks = seed
        else:
            live = np.flatnonzero(x)
            ranks = written(spark.createDataFrame(pa.table({"vid": ids[live], "rank": x[live]}), "vid long, rank double"), "walk-ranks")
        if num_iter:
            ranks = ranks.unionByName(written(walk.far_ranks(blocks, share(x if num_iter % 2 else before), alpha), "walk-ranks"))
        return ranks
    finally:
        if blocks is not None:
            blocks.unpersist()
        shared.destroy()


def random_walk_one_vs_all(vertices: DataFrame, edges: DataFrame, source: int,
                           num_iter: int = 100, alpha: float = 0.15) -> DataFrame:
    """Every other patient with its walk probability and its position
    in descending order (ties by id); positions via a distributed index,
    not a single-partition window."""
    r = random_walk(vertices, edges, source, num_iter, alpha)
    pats = r.where((F.col("kind") == PATIENT) & (F.col("vertex_id") != source)).select(
        F.col("vertex_id").alias("patient_id"), "rank", (-F.round("rank", 12)).alias("_neg"))
    pos = dense_index(pats, ["_neg", "patient_id"], "position", start=1)
    return pats.join(pos, ["_neg", "patient_id"]).select("patient_id", "rank", "position")


def power_iteration_clusters(similarities: DataFrame, k: int = 3, max_iter: int = 100,
                             seed: int | None = None) -> DataFrame:
    """PIC over (p1, p2, similarity) -> patient_id, cluster.

    The rounds of Spark's own PIC as joins and sums, so that a task holds no edges: values start at random (with a ``seed``: by degree) with
    sizes that add up to 1, are averaged over the neighbours by weight and scaled again, until the change between two rounds changes by
    less than max(1e-5 / vertices, 1e-8), or ``max_iter`` rounds; k-means with seed 0 then places them. The random start is a hash of
    the id, so reruns agree. The pairs are written once; a round writes one row per vertex. Pairs of an id with itself or with a null are ignored.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    half = written(similarities.select(F.col("p1").cast("long").alias("src"), F.col("p2").cast("long").alias("dst"), F.col("similarity").alias("w"))
                   .dropna().where("src <> dst"), "pic-pairs")
    edges = half.unionByName(half.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    degree = written(edges.groupBy("src").agg(F.sum("w").alias("d")).where("d > 0"), "pic-degrees")
    unit = (F.pmod(F.xxhash64("src", F.lit(0)), F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)
    angle = F.pmod(F.xxhash64("src", F.lit(1)), F.lit(1 << 53)).cast("double") * (2 * 3.141592653589793 / (1 << 53))
    start = F.sqrt(-2 * F.log(unit)) * F.cos(angle) if seed is None else F.col("d")
    state = degree.select(F.col("src").alias("id"), "d", start.alias("raw"), F.lit(0.0).alias("old"))
    n, scale = state.agg(F.count(F.lit(1)), F.sum(F.abs("raw"))).first()
    tolerance, before = max(1e-5 / max(n, 1), 1e-8), None
    state = state.select("id", "d", (F.col("raw") / F.lit(scale)).alias("value"))
    for _ in range(max_iter if n else 0):
        sums = (edges.join(maybe_broadcast(state.select(F.col("id").alias("dst"), "value")), "dst")
                .groupBy(F.col("src").alias("id")).agg(F.sum(F.col("w") * F.col("value")).alias("s")))
        step = written(sums.join(state, "id").select("id", "d", (F.col("s") / F.col("d")).alias("raw"), F.col("value").alias("old")), "pic-values")
        scale = step.agg(F.sum(F.abs("raw"))).first()[0]
        change = step.agg(F.sum(F.abs(F.col("raw") / F.lit(scale) - F.col("old")))).first()[0]
        state = step.select("id", "d", (F.col("raw") / F.lit(scale)).alias("value"))
        if before is not None and abs(change - before) < tolerance:
            break
        before = change
    points = state.select(F.col("id").alias("patient_id"), array_to_vector(F.array("value")).alias("features"))
    if not n:
        return points.select("patient_id", F.lit(0).alias("cluster"))
    return KMeans(k=k, seed=0, predictionCol="cluster").fit(points).transform(points).select("patient_id", "cluster")
