"""The rounds of the random walk on a graph of two sides, as array sums over blocks of edges.

The near side (the source's) is small enough for one array of doubles. Every edge is kept in a block of its far vertex, both ways
together, as positions in that array. So a far rank is made and used where its edges are: a block turns the near ranks into sums for the
near vertices, and what goes over the network is the near array, out to the tasks and back as one partial sum per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edges (of both ways) in a block, unless one far vertex has more: a worker holds one at a time, some 100 bytes an edge while it is made.
BLOCK_EDGES = 1_000_000
# Edges (of both ways) in a partition of blocks.
PARTITION_EDGES = 2_000_000
# Near vertices in one row of the sums of a step.
CHUNK = 1 << 16
# Ways of an edge: into the far vertex, out of it, and out of it to a null (which takes its share of the rank nowhere).
INTO, OUT, NOWHERE = 0, 1, 2
_BLOCK = "far binary, ins binary, in_at binary, outs binary, out_at binary, degree binary, most long"
_TYPES = (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32)


def block_of(far: np.ndarray, vid: np.ndarray, way: np.ndarray, ids: np.ndarray) -> tuple:
    """(far vertices, edges into each, their near positions, edges out of each, their near positions, out-degree of each) of edges sorted by
    far vertex. The edges out are None where they are the edges in turned round, as in a graph built from records."""
    first = np.concatenate(([True], far[1:] != far[:-1]))
    at, own = np.cumsum(first) - 1, far[first]

    def side(mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.sort(at[mine] * len(ids) + np.searchsorted(ids, vid[mine]))
        return np.bincount(key // len(ids), minlength=len(own)).astype(np.int32), (key % len(ids)).astype(np.int32)

    (ins, in_at), (outs, out_at) = side(way == INTO), side(way == OUT)
    degree = np.bincount(at[way != INTO], minlength=len(own)).astype(np.int32)
    if np.array_equal(ins, outs) and np.array_equal(in_at, out_at):
        outs = out_at = None
    return own, ins, in_at, outs, out_at, degree


def far_sums(block: tuple, share: np.ndarray) -> np.ndarray:
    """The sum of the near vertices' shares over the edges into each far vertex."""
    _, ins, in_at, *_ = block
    sums, some = np.zeros(len(ins)), ins > 0
    if some.any():
        sums[some] = np.add.reduceat(share[in_at], (np.cumsum(ins) - ins)[some])
    return sums


def near_sums(block: tuple, share: np.ndarray, alpha: float) -> np.ndarray:
    """What the far vertices of a block, with ranks of the round before, give each near vertex."""
    _, ins, in_at, outs, out_at, degree = block
    if outs is None:
        outs, out_at = ins, in_at
    give = (1.0 - alpha) * far_sums(block, share) / np.maximum(degree, 1)
    return np.bincount(out_at, weights=np.repeat(give, outs), minlength=len(share))


def blocks_task(shared, most_edges: int, target: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Task for ``mapInArrow`` over (far, vid, way) sorted by far: one row per block. ``most`` is the largest number of edges of one way that a
    far vertex of the block has; beyond ``target`` the row has nothing else and the rest is not kept."""
    def row(block: tuple | None, most: int) -> pa.RecordBatch:
        values = [None if x is None else x.astype(t, copy=False).tobytes() for x, t in zip(block or (None,) * 6, _TYPES, strict=True)]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([*[pa.array([x], pa.binary()) for x in values], pa.array([most], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        held, n = [], 0

        def cut(last: bool) -> tuple:
            far, vid, way = (np.concatenate(x) for x in zip(*held, strict=True))
            end = len(far) if last else int(np.searchsorted(far, far[-1]))
            block = block_of(far[:end], vid[:end], way[:end], ids) if end else None
            most = max([int(x.max()) for x in block[1:4:2] if x is not None], default=0) if end else int(np.bincount(way, minlength=2)[:2].max())
            return block, most, (far[end:], vid[end:], way[end:])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            n += batch.num_rows
            if n < most_edges:
                continue
            block, most, rest = cut(False)
            if most > target:
                yield row(None, most)
                for _ in batches:
                    pass
                return
            if block:
                yield row(block, most)
            held, n = [rest], len(rest[0])
        if n:
            block, most, _ = cut(True)
            yield row(None if most > target else block, most)

    return run


def blocks_of(edges: DataFrame, near: Callable, shared, n_edges: int, target: int) -> RDD | None:  # noqa: ANN001
    """The edges (src, dst), some ``n_edges`` of one way, in blocks by far vertex, persisted; ``shared`` are the sorted near vertices. None if a far vertex has more than ``target`` edges of one way."""
    rows = edges.select(
        F.when(near("src"), F.col("dst")).when(~near("src"), F.col("src")).cast("long").alias("far"),
        F.coalesce(F.when(near("src"), F.col("src")).otherwise(F.col("dst")), F.lit(0)).cast("long").alias("vid"),
        F.when(near("src"), INTO).when(F.col("dst").isNull(), NOWHERE).otherwise(OUT).cast("byte").alias("way")).where(F.col("far").isNotNull())
    n = max(1, -(-2 * n_edges // PARTITION_EDGES))
    made = rows.repartition(n, "far").sortWithinPartitions("far").mapInArrow(blocks_task(shared, BLOCK_EDGES, target), _BLOCK)

    def arrays(r) -> tuple:  # noqa: ANN001
        return r[6], tuple(None if x is None else np.frombuffer(x, t) for x, t in zip(r[:6], _TYPES, strict=True))

    blocks = made.rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)
    if blocks.map(lambda b: b[0]).fold(0, max) > target:
        blocks.unpersist()
        return None
    return blocks


def near_step(blocks: RDD, share: np.ndarray, alpha: float) -> np.ndarray:
    """The sums that two rounds give each near vertex, from its share (rank by out-degree) at their start."""
    sc = blocks.context
    shared, size = sc.broadcast(share), len(share)

    def run(some: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        sums = np.zeros(size)
        for _, block in some:
            sums += near_sums(block, shared.value, alpha)
        for lo in range(0, size, CHUNK):
            yield lo, sums[lo:lo + CHUNK]

    # A task takes several blocks, as each sends sums for the whole near side.
    tasks = blocks.coalesce(min(blocks.getNumPartitions(), 2 * sc.defaultParallelism)).mapPartitions(run)
    parts = tasks.reduceByKey(np.add, min(-(-size // CHUNK), sc.defaultParallelism)).collect()
    shared.destroy()
    return np.concatenate([x for _, x in sorted(parts, key=lambda p: p[0])])


def far_ranks(blocks: RDD, share: np.ndarray, alpha: float) -> DataFrame:
    """(vid, rank) of the far vertices that a round gives a rank."""
    from pyspark.sql import SparkSession

    shared = blocks.context.broadcast(share)

    def ranks(b: tuple) -> tuple[bytes, bytes]:
        rank = (1.0 - alpha) * far_sums(b[1], shared.value)
        return b[1][0][rank > 0].tobytes(), rank[rank > 0].tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vid, rank in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                vid, rank = np.frombuffer(vid, np.int64), np.frombuffer(rank, np.float64)
                for lo in range(0, len(vid), CHUNK):
                    yield pa.RecordBatch.from_arrays([pa.array(vid[lo:lo + CHUNK]), pa.array(rank[lo:lo + CHUNK])], names=["vid", "rank"])

    packed = SparkSession.active().createDataFrame(blocks.map(ranks), "vid binary, rank binary")
    return packed.mapInArrow(rows, "vid long, rank double")
