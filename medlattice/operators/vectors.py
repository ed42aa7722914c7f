"""Sparse feature vectors of any width, in time linear in their entries.

Spark has no expression that builds a sparse ML vector, so entries are sorted by index in the JVM and handed over as
Arrow lists, whose offsets and values become the vector's without a loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the tag of a sparse vector in Spark's vector type.
SPARSE = 0


def _vector_batches(width: int, pairs: str, out: str):
    """Arrow batches with the list column ``pairs`` in place of a vector column ``out``."""

    def vectors(lists: pa.Array) -> pa.Array:
        lists = lists.fill_null([]) if lists.null_count else lists
        flat = lists.flatten()
        idx, value = flat.field("idx"), flat.field("value")
        n = len(flat)
        if n:
            low, high = pc.min_max(idx).as_py().values()
            if idx.null_count or low < 0 or high >= width:
                raise ValueError(f"an index is null or outside 0 to {width - 1}: from {low} to {high}")
            rows = pc.list_parent_indices(lists)
            same = pc.and_(pc.equal(idx.slice(1), idx.slice(0, n - 1)), pc.equal(rows.slice(1), rows.slice(0, n - 1)))
            if pc.any(same).as_py():
                raise ValueError("a vector has an index twice")
        sizes = pc.list_value_length(lists)
        ends = pc.cumulative_sum(sizes.cast(pa.int32()))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        rows = len(lists)
        return pa.StructArray.from_arrays(
            [pa.repeat(pa.scalar(SPARSE, pa.int8()), rows), pa.repeat(pa.scalar(width, pa.int32()), rows),
             pa.ListArray.from_arrays(offsets, idx.cast(pa.int32())), pa.ListArray.from_arrays(offsets, value.cast(pa.float64()))],
            names=["type", "size", "indices", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != pairs]
            arrays = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, vectors(batch.column(pairs))], names=[*names, out])

    return run


def pairs_to_vectors(df: DataFrame, num_features: int, pairs: str = "pairs", out: str = "features") -> DataFrame:
    """``df`` with the column ``pairs`` (array of struct idx, value) turned into a sparse vector ``out`` of the given width.

    Null or empty pairs give the zero vector; a null value counts as 0. An index that is null, negative, repeated in its row or at or
    beyond the width raises, so nothing is dropped.
    """
    rest = [c for c in df.columns if c not in (pairs, out)]
    clean = F.transform(F.array_sort(F.col(pairs)), lambda p: F.struct(
        p["idx"].cast("long").alias("idx"), F.coalesce(p["value"].cast("double"), F.lit(0.0)).alias("value")))
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(out, VectorUDT())])
    return df.select(*rest, clean.alias(pairs)).mapInArrow(_vector_batches(num_features, pairs, out), schema)


def sparse_vectors(long_df: DataFrame, num_features: int, key: str = "patient_id", idx: str = "feature_idx",
                   value: str = "value", out: str = "features") -> DataFrame:
    """long form -> one sparse vector per key, as ``assemble_vectors`` but O(entries) and of any width."""
    per_key = long_df.groupBy(key).agg(F.collect_list(F.struct(F.col(idx).cast("long").alias("idx"), F.col(value).cast("double").alias("value"))).alias("_pairs"))
    return pairs_to_vectors(per_key, num_features, "_pairs", out)


def vector_entries(df: DataFrame, key: str, vector: str = "features") -> DataFrame:
    """key, idx, value: the stored entries of sparse vectors, without their zeros as dense arrays."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            indices = v.field("indices")
            yield pa.RecordBatch.from_arrays(
                [b.column("k").take(pc.list_parent_indices(indices)), indices.flatten(), v.field("values").flatten()], names=[key, "idx", "value"])

    schema = T.StructType([df.schema[key], T.StructField("idx", T.IntegerType()), T.StructField("value", T.DoubleType())])
    return df.select(F.col(key).alias("k"), F.col(vector).alias("v")).mapInArrow(entries, schema)


def _number(token: Column, kind: str, what: str, where: Column) -> Column:
    number = token.try_cast(kind)
    return F.when(number.isNull(), F.raise_error(F.concat(F.lit(f"{what} is no {kind}: "), where)).cast(kind)).otherwise(number)


def svmlight_pairs(spark: SparkSession, path: str, with_id: bool = False) -> DataFrame:
    """[patient_id], label, pairs of 0-based svmlight text; files are split by Spark's own text reader.

    Empty lines and what follows a ``#`` are ignored. A label, index or value that is no number, and a token without a colon,
    raise an error that names the file and the line.
    """
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("value"), F.col("_metadata.file_path").alias("_file"))
    where = F.concat(F.col("_file"), F.lit(": "), F.col("value"))
    toks = F.split("value", r"\s+")
    first = 2 if with_id else 1
    pairs = F.transform(F.slice(toks, first + 1, 1 << 30), lambda t: F.struct(
        _number(F.substring_index(t, ":", 1), "bigint", "an index", where).alias("idx"),
        _number(F.when(F.instr(t, ":") > 0, F.substring_index(t, ":", -1)), "double", "a value", where).alias("value")))
    ids = [_number(F.get(toks, F.lit(0)), "bigint", "an id", where).alias("patient_id")] if with_id else []
    return lines.where("value != ''").select(*ids, _number(F.get(toks, F.lit(first - 1)), "double", "a label", where).alias("label"), pairs.alias("pairs"))


def read_svmlight_sparse(spark: SparkSession, path: str, num_features: int | None = None, with_id: bool = False) -> DataFrame:
    """[patient_id], label, features as sparse vectors. Without ``num_features`` the width is found in a first pass (largest
    index + 1); with it, an index beyond it raises instead of being dropped."""
    parsed = svmlight_pairs(spark, path, with_id)
    if num_features is None:
        top = parsed.agg(F.max(F.array_max("pairs.idx")).alias("top")).first()["top"]
        num_features = 0 if top is None else top + 1
    return pairs_to_vectors(parsed, num_features)
