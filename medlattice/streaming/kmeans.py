"""Streaming k-means with Structured Streaming, safe to restart.

Each micro-batch of points updates a table of centers with the M14 rule. Batch b is written to
``<state>/batch_id=b`` and then committed: a file in ``<state>/commits``, made in one step and never overwritten, names the batch and the
stream's checkpoint. A start reads the commits: the newest committed centers go on, and the initial centers are used only where
there are none. A batch that the stream replays after a failure is skipped if it is committed, and written again if it is not. A batch whose
predecessor is not committed raises, and so does a state that belongs to another checkpoint. Folders live under
the session's ``spark.checkpoint.dir`` (a shared folder on a cluster).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice.operators.models import random_centers, streaming_kmeans_update
from medlattice.session import ensure_checkpoint_dir

CENTER_SCHEMA = "cluster int, center array<double>, weight double"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def _commit(spark: SparkSession, state: str, batch_id: int, stream: str) -> None:
    fs, p = _file_system(spark, f"{state}/commits/batch-{batch_id}.json")
    out = fs.create(p, False)  # fails if the batch is committed already
    out.writeBytes(json.dumps({"batch_id": batch_id, "stream": stream}))
    out.close()


def committed_batches(spark: SparkSession, state: str) -> dict[int, str]:
    """Committed batch id -> identity of the stream's checkpoint (empty for the initial centers, batch -1). A commit that was cut short does not count."""
    if not _path_exists(spark, f"{state}/commits"):
        return {}
    rows = spark.read.schema("batch_id long, stream string").json(f"{state}/commits").collect()
    return {r["batch_id"]: r["stream"] for r in rows if r["batch_id"] is not None and r["stream"] is not None}


def _stream_id(spark: SparkSession, ckpt: str) -> str:
    """The identity that the stream's checkpoint keeps over restarts."""
    return spark.read.schema("id string").json(f"{ckpt}/metadata").first()["id"]


def run_streaming_kmeans(spark: SparkSession, points: DataFrame, initial_centers: DataFrame,
                         decay: float = 1.0, point_col: str = "x", work_dir: str | None = None,
                         available_now: bool = True, unit: str = "batches") -> tuple[str, int]:
    """Run the stream over ``points`` (a streaming DataFrame) to the end of
    the available input. Returns (state folder, newest committed batch id; -1 where there was no batch).

    The same ``work_dir`` goes on where the last run ended; ``initial_centers`` then play no part.
    """
    base = work_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streaming-kmeans-{uuid.uuid4().hex}"
    state, ckpt = f"{base}/centers", f"{base}/checkpoint"
    done = committed_batches(spark, state)
    if not done:
        initial_centers.select("cluster", "center", "weight").write.mode("overwrite").parquet(f"{state}/batch_id=-1")
        _commit(spark, state, -1, "")
    elif max(done) >= 0 and not _path_exists(spark, f"{ckpt}/metadata"):
        raise RuntimeError(f"the centers in {state} belong to a checkpoint that is gone")

    def update(batch: DataFrame, batch_id: int) -> None:
        done, stream = committed_batches(spark, state), _stream_id(spark, ckpt)
        if any(s not in ("", stream) for s in done.values()):
            raise RuntimeError(f"the centers in {state} belong to another checkpoint")
        if batch_id in done:  # replayed: its points are in the centers
            return
        if batch_id - 1 not in done:
            raise RuntimeError(f"batch {batch_id - 1} was never committed in {state}")
        prev = spark.read.schema(CENTER_SCHEMA).parquet(f"{state}/batch_id={batch_id - 1}")
        new = streaming_kmeans_update(prev, batch.select(F.col(point_col).alias("x")), decay=decay, unit=unit)
        new.select("cluster", "center", "weight").write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        _commit(spark, state, batch_id, stream)

    writer = points.writeStream.foreachBatch(update).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    q.awaitTermination()
    return state, max(committed_batches(spark, state))


def latest_centers(spark: SparkSession, state: str, batch_id: int | None = None) -> DataFrame:
    """The centers after a batch (default: the newest committed one)."""
    done = committed_batches(spark, state)
    batch_id = max(done) if batch_id is None else batch_id
    if batch_id not in done:
        raise RuntimeError(f"batch {batch_id} is not committed in {state}")
    return spark.read.schema(CENTER_SCHEMA).parquet(f"{state}/batch_id={batch_id}")


def embedding_point_stream(spark: SparkSession, data_dir: str, dim: int = 10) -> DataFrame:
    """Embeddings files read as a stream (one file per micro-batch), first
    ``dim`` components as the point."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()),
                           T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType())])
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .parquet(f"{data_dir.rstrip('/')}/embeddings*.parquet"))
    return s.select(F.slice("embedding", 1, dim).cast("array<double>").alias("x"))


def streaming_kmeans_centers(spark: SparkSession, data_dir: str, k: int = 3, dim: int = 10,
                             decay: float = 1.0) -> DataFrame:
    """Z1 end to end: random starting centers (seed 6250, weight 0.5), the
    embeddings stream, final centers."""
    init = random_centers(spark, k, dim)
    state, last = run_streaming_kmeans(spark, embedding_point_stream(spark, data_dir, dim), init, decay)
    return latest_centers(spark, state, last)
