"""Session helpers: building a session, the checkpoint folder, size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Broadcast a side only when its estimated size is below this bound.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def get_spark(app: str = "medlattice", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it when needed.

    On a cluster the shared folder comes from ``spark.checkpoint.dir``; we
    only create a scratch folder when that setting is absent and Spark runs
    in local mode (tests, laptops).
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="medlattice-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back.

    For loops: it cuts the lineage, outlives lost executors, and the planner sees the written size (a checkpointed DataFrame
    keeps its plan's estimate, and the estimates of joins multiply from round to round).
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (no job runs). For joins and
    aggregates the estimate is an upper bound in practice (it assumes no
    reduction), so a small estimate is a safe proof of smallness."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) if isinstance(size, int) else int(size.toString())


def proven_small(df: DataFrame, bound_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when the plan's size estimate of ``df`` is below the bound (no job runs)."""
    try:
        return estimated_bytes(df) <= bound_bytes
    except Exception:  # noqa: BLE001 - statistics unavailable
        return False


def settle(df: DataFrame) -> DataFrame:
    """Compute a derived lookup table once and return it with its real size.

    The optimizer sizes a table derived from data (a dense index over the
    distinct codes of an event table) like its input, so no size check on
    it can succeed, and a join against it is planned as a shuffle of the
    data-sized side. The table is persisted (memory and disk; blocks lost
    with an executor are recomputed from lineage) and counted once; plans
    built on the returned DataFrame read the cached relation, whose
    statistics are the measured size, so :func:`maybe_broadcast` decides
    on the real size.
    """
    from pyspark import StorageLevel

    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    cached.count()
    return cached.select(*df.columns)


def maybe_broadcast(df: DataFrame, bound_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the plan's size estimate is below the bound.

    No job is run. Beyond the bound the plain DataFrame is returned; Spark
    then plans a shuffle join, and AQE may still switch to a broadcast at
    run time once a shuffle stage's real size is known to be small
    (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if proven_small(df, bound_bytes) else df
