"""Sharding by a two-pass external shuffle.

First pass: a seeded hash scatters records uniformly into buckets of a size that fits in memory. Second
pass: each bucket is put in a canonical order, shuffled by Fisher-Yates with its own seed, and written. The buckets in
turn are one random order of all rows, cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from medlattice.llm.common import settle, shared_path

BUCKET_BYTES = 16 << 20
_TOGETHER = 4096


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A random order of n rows, the same for the same seed and bucket (numpy's permutation is a Fisher-Yates shuffle)."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def _starts(buckets: DataFrame) -> DataFrame:
    """(bucket, rows) -> (bucket, before): the rows of all buckets before, in two steps, so that a task sums a bounded part of them."""
    part = buckets.withColumn("part", F.floor(F.col("bucket") / _TOGETHER))
    parts = part.groupBy("part").agg(F.sum("rows").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("inside", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    return part.join(parts, "part").select("bucket", (F.col("base") + F.col("inside")).alias("before"))


def write_shards(df: DataFrame, shards: int = 16, seed: int = 20240913, id_col: str = "doc_id", text_col: str = "text",
                 bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Write the rows of ``df`` into folders ``shard=0`` and so on below ``path`` (default: a new one in the shared folder), in the order of
    their ``slot`` (gapless from 0 in each shard), and return them as read back.

    Shard sizes differ by one row at most. The same rows, seed and bucket size give the same shards, however the input is
    partitioned; rows are told apart by id and text, and rows that repeat both are interchangeable. Null ids and texts are values
    of their own; empty table: no rows, no files. Equal texts with different ids scatter like other rows. Rows that repeat id and
    text share a bucket; one that they make too large is dealt again by position. Memory follows a bucket or the longest text. Columns named shard or slot are replaced.
    """
    names = [c for c in df.columns if c not in ("shard", "slot")]
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 64
    total = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-total["bytes"] // bucket_bytes))
    rows = df.select(*names, F.pmod(F.xxhash64(F.lit(seed), id_col, text_col), F.lit(buckets)).alias("__bucket"),
                     F.xxhash64(F.lit(seed + 1), id_col, text_col).alias("__order"))
    sizes = settle(rows.groupBy(F.col("__bucket").alias("bucket")).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"), F.max(size).alias("longest")), "buckets")
    # Uniform hashing leaves buckets near their mean, with some room for long texts; what is far above holds repeated rows.
    crowded = sizes.where((F.col("bytes") > 4 * bucket_bytes + 16 * F.col("longest")) & (F.col("rows") > 1))
    if not crowded.isEmpty():
        split = crowded.select(F.col("bucket").alias("__bucket"), F.ceil(F.col("bytes") / bucket_bytes).alias("__ways"))
        again = settle(rows.join(split, "__bucket").withColumn("__turn", F.pmod(F.monotonically_increasing_id(), F.col("__ways")) + 1), "crowded")
        width = int(crowded.agg(F.max(F.ceil(F.col("bytes") / bucket_bytes))).first()[0]) + 1
        rows = rows.join(split, "__bucket", "left_anti").select(*names, (F.col("__bucket") * width).alias("__bucket"), "__order").unionByName(
            again.select(*names, (F.col("__bucket") * width + F.col("__turn")).alias("__bucket"), "__order"))
        sizes = settle(rows.groupBy(F.col("__bucket").alias("bucket")).agg(F.count("*").alias("rows")), "buckets")
    starts = _starts(sizes)
    schema = StructType([f for f in df.schema.fields if f.name in names] + [StructField("shard", IntegerType()), StructField("slot", LongType())])
    n = total["n"]

    def deal(bucket: pa.Table, start: pa.Table) -> pa.Table:
        at, before = start["bucket"][0].as_py(), start["before"][0].as_py()
        canonical = np.argsort(bucket["__order"].to_numpy(), kind="stable")
        out = bucket.select(names).take(pa.array(canonical[fisher_yates(len(canonical), seed, at)]))
        place = before + np.arange(len(canonical), dtype=np.int64)
        shard = place * shards // n
        slot = place - -(-shard * n // shards)
        return out.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(slot))

    dealt = rows.groupBy("__bucket").cogroup(starts.groupBy("bucket")).applyInArrow(deal, schema)
    path = path or shared_path(df.sparkSession, "shards")
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path).select(*names, "shard", "slot")
