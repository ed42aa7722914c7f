"""Sinks K1-K8. Every writer is a distributed Spark write (one file per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, header: bool = True,
              sep: str = ",", mode: str = "overwrite") -> None:
    """K1/K2: chosen columns as delimited text (no row index)."""
    (df.select(*(columns or df.columns)).write.mode(mode)
     .option("header", header).option("sep", sep).option("dateFormat", "yyyy-MM-dd").csv(path))


def write_space_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: space-joined lines written as text, so values keep embedded blanks
    unquoted (CSV quoting would alter them)."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_text_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: pre-built text lines (e.g. svmlight) as text files."""
    lines.select(F.col(lines.columns[0]).alias("value")).write.mode(mode).text(path)


def write_predictions(df: DataFrame, path: str, id_col: str, value_col: str,
                      id_name: str = "patient_id", value_name: str = "label") -> None:
    """K5/K6: id,prediction CSV. The id travels with its prediction, so no
    positional pairing or length check is needed."""
    write_csv(df.select(F.col(id_col).alias(id_name), F.col(value_col).alias(value_name)), path)


def write_partitioned_parquet(df: DataFrame, path: str, partition_by: str = "split",
                              mode: str = "overwrite") -> None:
    """K7: datasets per split (code maps, ids, labels, sequences)."""
    df.write.mode(mode).partitionBy(partition_by).parquet(path)


def save_model(model, path: str) -> None:
    """K8: persist a fitted ML model/pipeline; reload with ``<Model>.load``."""
    model.write().overwrite().save(path)
