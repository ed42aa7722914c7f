"""Published tables and models in versioned folders, with a manifest written last.

``root/versions/<version>-<token>`` holds the data and ``root/manifest`` a line of JSON for each complete version. A write that fails leaves a
folder that no line names, so it is never read. Both are Spark writes, so any file system that Spark reaches will do.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, path string, kind string, name string, rows long"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The complete versions: version, path, kind, name, rows. Empty if nothing was published."""
    try:
        return spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(f"{root.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def latest(spark: SparkSession, root: str, name: str, version: int | None = None) -> Row:
    """The newest complete version of ``name`` (two writers of one version: the larger path), or that version; raises if there is none."""
    found = versions(spark, root).where(F.col("name") == name)
    if version is not None:
        found = found.where(F.col("version") == version)
    row = found.agg(F.max_by(F.struct("*"), F.struct("version", "path"))).first()[0]
    if row is None:
        raise FileNotFoundError(f"no complete version of {name} under {root}" + ("" if version is None else f" with number {version}"))
    return row


def _publish(spark: SparkSession, root: str, name: str, kind: str, write) -> int:
    newest = versions(spark, root).where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (newest or 0) + 1
    path = f"{root.rstrip('/')}/versions/{version}-{uuid.uuid4().hex}"
    rows = write(path)
    line = spark.createDataFrame([(version, path, kind, name, rows)], MANIFEST)
    line.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/manifest")
    return version


def publish_table(df: DataFrame, root: str, name: str) -> int:
    """Write ``df`` as the next version of ``name`` and return its number, counted from 1."""
    spark = df.sparkSession

    def write(path: str) -> int:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path).count()

    return _publish(spark, root, name, "table", write)


def read_table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The newest complete version (or the given one) of a published table."""
    return spark.read.parquet(latest(spark, root, name, version)["path"])


def publish_model(spark: SparkSession, model, root: str, name: str) -> int:
    """Save a fitted model or pipeline as the next version of ``name``."""

    def write(path: str) -> None:
        model.write().save(path)

    return _publish(spark, root, name, "model", write)


def read_model(spark: SparkSession, root: str, name: str, version: int | None = None):
    """The newest complete version (or the given one) of a published model, of whatever class it was saved from."""
    from pyspark.ml.util import DefaultParamsReader

    return DefaultParamsReader.loadParamsInstance(latest(spark, root, name, version)["path"], spark)
