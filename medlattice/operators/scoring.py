"""M9 for many models: scores of sparse samples under an ensemble, as a product of blocks.

Models are taken in blocks of BLOCK; a block's weights of one feature are one row with a column per model, so an entry of a sample meets
one row per block instead of one per model, and the sums of a sample and a block are BLOCK columns added map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalars import sigmoid
from medlattice.operators.indexing import dense_index
from medlattice.operators.metrics import attach_row
from medlattice.session import maybe_broadcast

# Models whose weights share a row.
BLOCK = 16
# Sample entries of one feature per (feature, salt) task, where the weights are too large to broadcast.
SALT_TARGET = 100_000


def weight_blocks(weights: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(blocks, sizes) of weights (model_id, idx, weight): block, idx, w0.. and block, models. Rows with a null model or index are
    ignored, a null weight is 0, and weights of a repeated (model, index) are added. Every model counts, also one whose weights are all 0."""
    models = dense_index(weights, ["model_id"], "_ord").withColumn("block", F.floor(F.col("_ord") / block).cast("int"))
    slot = F.pmod(F.col("_ord"), F.lit(block))
    w = weights.dropna(subset=["model_id", "idx"]).join(maybe_broadcast(models), "model_id")
    blocks = w.groupBy("block", "idx").agg(*[F.sum(F.when(slot == i, F.col("weight")).otherwise(0.0)).alias(f"w{i}") for i in range(block)])
    return blocks.fillna(0.0), models.groupBy("block").agg(F.count(F.lit(1)).alias("models"))


def many_model_probability(weights: DataFrame, samples: DataFrame, key: str = "patient_id", block: int = BLOCK,
                           salt_target: int = SALT_TARGET, broadcast_weights: bool = True) -> DataFrame:
    """key, probability: the mean over all models of sigmoid(w . x) for samples (key, pairs of idx and value), like
    ``ensemble_probability``, whose join has a row per (entry, model).

    Small blocks are broadcast behind a check of their size. Otherwise entries meet blocks on (idx, salt): a feature with many entries is
    split, and its few block rows are repeated. A model without weights on a sample's features has margin 0, so 1/2. Keys are
    distinct; without any model the probability is null.
    """
    blocks, sizes = weight_blocks(weights, block)
    entries = samples.select(key, F.explode("pairs").alias("p")).select(key, F.col("p.idx").alias("idx"), F.col("p.value").alias("value"))
    side = maybe_broadcast(blocks) if broadcast_weights else blocks
    if side is blocks:
        ways = (entries.groupBy("idx").agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_target)).alias("ways")).where("ways > 1"))
        salts = F.coalesce("ways", F.lit(1))
        entries = entries.join(maybe_broadcast(ways), "idx", "left").withColumn("salt", F.pmod(F.xxhash64(key), salts)).drop("ways")
        blocks = (blocks.join(maybe_broadcast(ways), "idx", "left")
                  .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("ways"))
        met = entries.join(blocks, ["idx", "salt"])
    else:
        met = entries.join(side, "idx")
    margins = met.groupBy(key, "block").agg(*[F.sum(F.col("value") * F.col(f"w{i}")).alias(f"m{i}") for i in range(block)])
    chances = [F.when(F.col("models") > i, sigmoid(f"m{i}")).otherwise(0.0) for i in range(block)]
    total = chances[0]
    for c in chances[1:]:
        total = total + c
    # One row per block of models.
    per_key = margins.join(maybe_broadcast(sizes), "block").groupBy(key).agg(F.sum(total).alias("_s"), F.sum("models").alias("_k"))
    full = attach_row(samples.select(key).distinct().join(per_key, key, "left"), sizes.agg(F.sum("models").alias("_M")))
    s, k = F.coalesce("_s", F.lit(0.0)), F.coalesce("_k", F.lit(0))
    return full.select(key, F.try_divide(s + (F.col("_M") - k) * 0.5, F.col("_M")).alias("probability"))
