"""Sources S1-S11: delimited text, candidate lists, svmlight, nested parquet.

Schemas are declared, never inferred from data; files are read by Spark's
own scanners so they split across tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice.functions.scalars import normalized_name

# Fixed value: the table-name pattern of a CSV path (last word, optional .csv).
TABLE_NAME_PATTERN = re.compile(r"(\w+)(\.csv)?$")

# Declared schemas of the logical inputs.
EVENTS_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_description", T.StringType()),
    T.StructField("timestamp", T.DateType()),
    T.StructField("value", T.DoubleType()),
])
MORTALITY_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()),
    T.StructField("timestamp", T.DateType()),
    T.StructField("label", T.IntegerType()),
])
FEATURE_MAP_SCHEMA = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("event_id", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             sep: str = ",", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Delimited text with a declared schema (header optional)."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("dateFormat", date_format).csv(path))


def table_name_from_path(path: str) -> str:
    """``.../PATIENT.csv`` -> ``PATIENT``; the path itself when no match."""
    m = TABLE_NAME_PATTERN.search(path)
    return m.group(1) if m else path


def load_csv_table(spark: SparkSession, path: str, name: str | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """CSV with header, comma-separated, malformed rows dropped, all
    columns text unless a schema is given; registered as a temp view.

    CSV column pruning is switched off for the session: with it, a query
    that needs few columns (``count()``) skips parsing the rest and keeps
    rows that DROPMALFORMED should drop.
    """
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("sep", ",")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    df.createOrReplaceTempView(name or table_name_from_path(path))
    return df


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """One candidate value per line, lower-cased and trimmed, distinct."""
    return (spark.read.text(path).select(normalized_name("value").alias("value"))
            .where(F.col("value") != "").distinct())


def parse_svmlight(lines: DataFrame, with_id: bool = False, col: str = "value") -> DataFrame:
    """S7 for 0-based files: ``[id] label i:v i:v ...`` -> id?, label, pairs.

    Spark's libsvm source is 1-based and rejects index 0, so the text is
    split with built-in functions instead: pairs is array<struct<idx:int,
    value:double>>.
    """
    toks = F.split(F.trim(F.col(col)), r"\s+")
    start = 2 if with_id else 1
    feats = F.slice(toks, start + 1, 1 << 30)
    pairs = F.transform(
        F.filter(feats, lambda t: F.instr(t, ":") > 0),
        lambda t: F.struct(F.split(t, ":")[0].cast("int").alias("idx"),
                           F.split(t, ":")[1].cast("double").alias("value")))
    cols = ([toks[0].cast("long").alias("patient_id")] if with_id else []) + [
        toks[start - 1].cast("double").alias("label"), pairs.alias("pairs")]
    return lines.select(*cols)


def read_svmlight(spark: SparkSession, path: str, num_features: int = 3190,
                  with_id: bool = False) -> DataFrame:
    """Svmlight text -> label, features (ML vector of width ``num_features``)."""
    from pyspark.ml.functions import array_to_vector

    parsed = parse_svmlight(spark.read.text(path), with_id=with_id)
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(num_features - 1)),
        lambda i: F.coalesce(F.try_element_at(F.map_from_entries(F.col("pairs")), i), F.lit(0.0)))
    keep = ["patient_id"] if with_id else []
    return parsed.select(*keep, "label", array_to_vector(dense).alias("features"))


def read_seizure_csv(spark: SparkSession, path: str, n_inputs: int = 178) -> DataFrame:
    """Wide CSV X1..Xn, y in 1..5 -> features vector, 0-based label."""
    from pyspark.ml.feature import VectorAssembler

    schema = T.StructType([T.StructField(f"X{i}", T.DoubleType()) for i in range(1, n_inputs + 1)]
                          + [T.StructField("y", T.IntegerType())])
    df = spark.read.schema(schema).option("header", True).csv(path)
    vec = VectorAssembler(inputCols=[f"X{i}" for i in range(1, n_inputs + 1)], outputCol="features")
    return vec.transform(df).select("features", (F.col("y") - 1).alias("label"))


def read_sequences(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Persisted ids, labels and visit sequences (parquet, partitioned by split)."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def read_model_weights(spark: SparkSession, path: str) -> DataFrame:
    """A folder of trained linear models as (model_id, idx, weight)."""
    return spark.read.parquet(path).select("model_id", "idx", "weight")
