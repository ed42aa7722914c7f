"""G7 on a sparse graph with every patient: power iteration over the similarity join above a threshold.

Patients with equal sets are one vertex with a weight, so copies cost nothing; every vertex has a loop (similarity 1 to itself and to its
copies), so a patient without a similar one is kept and stays by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.operators import similarity
from medlattice.session import written


def class_graph(pairs: DataFrame, patients: DataFrame, threshold: tuple[int, int],
                code_cols: tuple[str, ...] = ("kind", "code")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, vertices, edges): patient_id, class_id for every patient, class_id, members, and src, dst, weight in both
    directions with loops, where weight = similarity * members of dst, divided by its sum over a src. A patient
    without codes is a class of its own."""
    members, classes = similarity.set_classes(pairs, code_cols)
    alone = patients.select(F.col("patient_id").cast("long")).dropna().distinct().join(members.select("patient_id"), "patient_id", "left_anti")
    members = members.unionByName(alone.withColumn("class_id", F.col("patient_id")))
    vertices = written(classes.select("class_id", "members").unionByName(
        alone.select(F.col("patient_id").alias("class_id"), F.lit(1).cast("long").alias("members"))), "class-vertices")
    near = written(similarity.similar_classes(classes, threshold), "similar-classes")
    half = near.select(F.col("class_1").alias("src"), F.col("class_2").alias("dst"), (F.col("similarity") * F.col("members_2")).alias("w"))
    back = near.select(F.col("class_2").alias("src"), F.col("class_1").alias("dst"), (F.col("similarity") * F.col("members_1")).alias("w"))
    loops = vertices.select(F.col("class_id").alias("src"), F.col("class_id").alias("dst"), F.col("members").cast("double").alias("w"))
    edges = half.unionByName(back).unionByName(loops)
    total = edges.groupBy("src").agg(F.sum("w").alias("_t"))
    return members, vertices, edges.join(total, "src").select("src", "dst", (F.col("w") / F.col("_t")).alias("weight"))


def start_values(vertices: DataFrame, seed: int) -> DataFrame:
    """class_id, value in [0, 1): a hash of (class_id, seed) of 53 bits."""
    top = 1 << 53
    return vertices.select("class_id", (F.pmod(F.xxhash64("class_id", F.lit(seed)), F.lit(top)).cast("double") / top).alias("value"))


def averaged(edges: DataFrame, values: DataFrame) -> DataFrame:
    """class_id, value: one round, each vertex' weighted mean of its neighbours."""
    return (edges.join(values.withColumnRenamed("class_id", "dst"), "dst").groupBy(F.col("src").alias("class_id"))
            .agg(F.sum(F.col("weight") * F.col("value")).alias("value")))


def power_iteration_values(edges: DataFrame, start: DataFrame, max_rounds: int = 100, tolerance: float = 1e-5) -> DataFrame:
    """class_id, value after power iteration: it stops, before vertices of one component are all alike, when no vertex' change between
    two rounds differs from the change before by more than ``tolerance``, or after ``max_rounds``. Each round is written to the
    shared folder, so lost executors repeat one round at most."""
    edges = written(edges, "similarity-edges")
    state = written(start.select("class_id", "value", F.lit(None).cast("double").alias("change")), "power-values")
    for _ in range(max_rounds):
        new = averaged(edges, state.select("class_id", "value")).withColumnRenamed("value", "_new")
        step = state.join(new, "class_id").select("class_id", F.col("_new").alias("value"), F.abs(F.col("_new") - F.col("value")).alias("now"), "change")
        step = written(step, "power-step")
        speed = step.agg(F.max(F.abs(F.col("now") - F.col("change")))).first()[0]
        state = step.select("class_id", "value", F.col("now").alias("change"))
        if speed is not None and speed <= tolerance:
            break
    return state.select("class_id", "value")


def clusters_on_line(values: DataFrame, k: int, value: str = "value", weight: str = "members", max_rounds: int = 50) -> DataFrame:
    """``values`` with ``cluster`` 0.. by ascending center: weighted k-means of single numbers. Centers start at the smallest number, then each
    time at the one farthest from all centers (ties: the smallest), so the result does not hang on the order of rows. Fewer distinct numbers
    than k give fewer clusters. The driver holds k numbers."""
    x = F.col(value)

    def nearest(centers: list[float]):
        return F.array_min(F.array(*[F.struct(F.abs(x - c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]))

    centers = [v for v in values.agg(F.min(x)).first() if v is not None]
    while centers and len(centers) < k:
        far = values.agg(F.max(F.struct(nearest(centers)["d"].alias("d"), (-x).alias("x")))).first()[0]
        if far["d"] == 0:
            break
        centers.append(-far["x"])
    centers.sort()
    for _ in range(max_rounds if centers else 0):
        means = values.groupBy(nearest(centers)["i"].alias("i")).agg((F.sum(x * F.col(weight)) / F.sum(weight)).alias("c")).collect()
        moved = sorted({**dict(enumerate(centers)), **{r.i: r.c for r in means}}.values())
        if moved == centers:
            break
        centers = moved
    return values.withColumn("cluster", nearest(centers)["i"] if centers else F.lit(None).cast("int"))


def threshold_clusters(pairs: DataFrame, patients: DataFrame, threshold: tuple[int, int], k: int = 3, seed: int = 0,
                       code_cols: tuple[str, ...] = ("kind", "code"), max_rounds: int = 100, tolerance: float = 1e-5) -> DataFrame:
    """patient_id, cluster for every patient, by power iteration over the graph of similarities of at least ``threshold``."""
    members, vertices, edges = class_graph(pairs, patients, threshold, code_cols)
    members = written(members, "class-members")
    values = power_iteration_values(edges, start_values(vertices, seed), max_rounds, tolerance)
    placed = clusters_on_line(written(values.join(vertices, "class_id"), "power-final"), k)
    return members.join(placed.select("class_id", "cluster"), "class_id").select("patient_id", "cluster")
