"""Hard negatives by slot-decomposed selection.

A positive's upper limit is the largest score that a negative may have beside it. The limits of an anchor's positives, in
descending order, split scores into disjoint slots; every row of another label falls into one slot at most. A combiner in each
task keeps the best few rows of each (anchor, slot), and a merge by anchor and slot keeps the best of all tasks. A positive's
window is a suffix of the slots, cut below by its lower limit: taking slots in descending order until there are enough rows
answers all of an anchor's overlapping windows from one small list.

Anchors (a stated query set) meet all rows in blocks: a group of anchors of at most ANCHOR_BYTES goes to every task, and
rows are scored where they are read, so no row is shuffled. Groups follow one another; each is one pass over the
rows for positives and one for negatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlattice.llm.common import settle, shared_path

# Largest broadcast, in bytes of the anchors' components; at most MOST_ANCHORS share one group.
ANCHOR_BYTES = 8 << 20
MOST_ANCHORS = 16384
_ANCHOR_BLOCK, _ROW_BLOCK = 512, 4096
_NONE = np.iinfo(np.int64).min

FOUND = "anchor int, slot int, score long, id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Anchors:
    """One group of anchors, and the limits of their slots: anchors x slots, descending."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray | None = None


def _matrix(lists: pa.Array) -> np.ndarray:
    """Float64 rows of a list array; shorter vectors end in zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices of whole numbers; beyond 64 bits they raise."""
    width = min(a.shape[1], b.shape[1])  # missing components are zeros
    a, b = a[:, :width], b[:, :width]
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1) < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T
    if exact.size and (exact.max() >= 1 << 63 or exact.min() <= -(1 << 63)):
        raise OverflowError("a score is beyond 64 bits")
    return exact.astype(np.int64)


class Combiner:
    """The best ``keep`` rows of each (anchor, slot): higher scores first, ties by smaller id. A row that repeats an id with the same score counts once."""

    def __init__(self, groups: int, keep: int):
        self.keep = keep
        self.group, self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        # The last of a full group; rows that do not come before it are not candidates.
        self.last_score, self.last_id = np.full(groups, _NONE), np.full(groups, np.iinfo(np.int64).max)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        g, s, i = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, g))
        g, s, i = g[order], s[order], i[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])
        g, s, i = g[new], s[new], i[new]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
        full = place == self.keep - 1
        self.last_score[g[full]], self.last_id[g[full]] = s[full], i[full]
        kept = place < self.keep
        self.group, self.score, self.id = g[kept], s[kept], i[kept]


def _best(rows: DataFrame, anchors: Anchors, keep: int) -> DataFrame:
    """FOUND: for each anchor the best ``keep`` other rows of its label (without limits), or of other labels in each slot."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        slots = 1 if a.limits is None else a.limits.shape[1]
        best = Combiner(len(a.ids) * slots, keep)
        step = 64  # small blocks first, so that few rows are candidates before the groups fill
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(2))
            _, codes = np.unique(np.concatenate([a.labels, batch.column(1).to_numpy(zero_copy_only=False).astype(str)]), return_inverse=True)
            own, labels = codes[:len(a.ids)], codes[len(a.ids):]
            at = 0
            while at < len(ids):
                end = min(at + step, len(ids))
                for f in range(0, len(a.ids), _ANCHOR_BLOCK):
                    t = min(f + _ANCHOR_BLOCK, len(a.ids))
                    scores = inner_products(a.vectors[f:t], vectors[at:end])
                    same = own[f:t, None] == labels[None, at:end]
                    who = np.arange(f, t)[:, None] * slots
                    for slot in range(slots):
                        last, last_id = (x[f * slots + slot:t * slots:slots, None] for x in (best.last_score, best.last_id))
                        better = (scores > last) | ((scores == last) & (ids[None, at:end] < last_id))
                        if a.limits is None:
                            better &= same & (a.ids[f:t, None] != ids[None, at:end])
                        else:
                            better &= ~same & (scores <= a.limits[f:t, slot, None])
                            if slot + 1 < slots:
                                better &= scores > a.limits[f:t, slot + 1, None]
                        x, y = np.nonzero(better)
                        best.add((who[x] + slot)[:, 0], scores[x, y], ids[at + y])
                at, step = end, min(_ROW_BLOCK, 8 * step)
        yield pa.RecordBatch.from_arrays(
            [pa.array((best.group // slots).astype(np.int32)), pa.array((best.group % slots).astype(np.int32)), pa.array(best.score), pa.array(best.id)],
            names=["anchor", "slot", "score", "id"])

    found = rows.mapInArrow(scan, FOUND).distinct()
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def valid_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(id, label, vector): rows with an id, a label and a vector of finite components, each floor(scale * component)."""
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                       F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("vector"))


def mine_hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100),
                        scale: float = 256.0) -> DataFrame:
    """RESULT: for each anchor and each of its best ``positives`` rows of the same label, the best ``negatives``
    rows of other labels whose score is between the two shares (numerator, denominator) of the positive's score.

    ``is_anchor`` is a condition on the column ``id``. Scores are integer inner products; higher ones come first, ties
    by smaller id. Rows with a null id, label or vector, or a null or non-finite component, take no part.
    Shorter vectors end in zeros. Rows that repeat an id with the same score count once, and a row is no partner of its own id.
    Anchors without a positive, and positives without a negative, have no rows; a table without anchors gives none. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = valid_rows(df, id_col, vector_col, label_col, scale)
    queries = settle(rows.where(is_anchor).distinct(), "anchors")
    many, width = queries.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    path = shared_path(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    most = max(1, min(MOST_ANCHORS, ANCHOR_BYTES // (8 * max(1, width))))
    groups = -(-many // most)
    group = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(max(1, groups)))
    while groups and queries.groupBy(group).count().agg(F.max("count")).first()[0] > most:  # hashing fills groups unevenly
        groups += -(-groups // 8)
        group = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(groups))
    for g in range(groups):
        part = queries.where(group == g).sort("id", "label", "vector").toArrow().combine_chunks()
        anchors = Anchors(part["id"].to_numpy(), part["label"].to_numpy(zero_copy_only=False).astype(str), _matrix(part["vector"]))
        chosen = settle(_best(rows, anchors, positives).select("anchor", "place", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "positives")
        anchors.limits = np.full((len(anchors.ids), positives), _NONE)
        got = chosen.toArrow()  # at most MOST_ANCHORS * positives rows
        for i, place, score in zip(got["anchor"].to_pylist(), got["place"].to_pylist(), got["positive_score"].to_pylist()):
            anchors.limits[i, place - 1] = score * high[0] // high[1]
        slots = _best(rows, anchors, negatives)
        # Suffix merges: at most positives * negatives rows an anchor, best first, which is by slot.
        best = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "score", "id"))).alias("best"))
        suffix = F.slice(F.filter("best", lambda x: x["slot"] >= F.col("place") - 1), 1, negatives)
        exact = F.lit(low[0]).cast("decimal(38,0)") * F.col("positive_score")
        window = F.filter(suffix, lambda x: exact <= F.lit(low[1]).cast("decimal(38,0)") * x["score"])
        names = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(len(anchors.ids), dtype=np.int32)), "anchor_id": anchors.ids}))
        out = (chosen.join(best, "anchor").join(names, "anchor")
               .select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "negative"))
               .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
                       "positive_score", F.col("negative.score").alias("negative_score")))
        out.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
