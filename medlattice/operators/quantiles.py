"""Exact percentiles of groups by distributed order statistics.

``percentile`` keeps a map of a group's values in one task. Here distinct (group, value) counts are range-partitioned by group and
value, running counts place each value within its group, and only the rows that hold a wanted position are
kept. A group's values are spread over as many tasks as they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlattice.session import ensure_checkpoint_dir


def exact_percentiles(df: DataFrame, group_cols: list[str], value_col: str, fractions: dict[str, float],
                      num_partitions: int | None = None) -> DataFrame:
    """A4: group columns, one interpolated exact percentile per entry of ``fractions`` (column name -> share in 0..1).

    As Spark's ``percentile``: position share * (n - 1), linear between the two values beside it. Null values are ignored; a group
    without other values has null percentiles. Null groups are groups of their own.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_g{i}" for i in range(len(group_cols))]
    counts = df.select(*[F.col(c).alias(k) for c, k in zip(group_cols, keys)], F.col(value_col).cast("double").alias("_v")).groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_n"))
    # Written once: a second range exchange would sample bounds of its own.
    ranged = counts.repartitionByRange(parts, *keys, "_v").withColumn("_part", F.spark_partition_id()).checkpoint()
    known = ranged.where(F.col("_v").isNotNull())
    totals = known.groupBy(*keys, "_part").agg(F.sum("_n").alias("_total"))
    group = Window.partitionBy(*keys)
    starts = totals.select(*keys, "_part", F.sum("_total").over(group).alias("_all"),
                           F.coalesce(F.sum("_total").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    same = [F.col(f"k.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys] + [F.col("k._part") == F.col("s._part")]
    placed = known.alias("k").join(starts.alias("s"), same).select(*[F.col(f"k.{k}").alias(k) for k in keys], "_v", "_n", "_all", "_start", F.col("k._part").alias("_part"))
    within = Window.partitionBy(*keys, "_part").orderBy("_v")
    placed = placed.withColumn("_end", F.col("_start") + F.sum("_n").over(within)).withColumn("_from", F.col("_end") - F.col("_n"))

    def holds(place):
        return (F.col("_from") <= place) & (place < F.col("_end"))

    wanted, columns = F.lit(False), []
    for name, share in fractions.items():
        at = F.lit(float(share)) * (F.col("_all") - 1)
        low, high = F.floor(at), F.ceil(at)
        wanted = wanted | holds(low) | holds(high)
        a, b = F.max(F.when(holds(low), F.col("_v"))), F.max(F.when(holds(high), F.col("_v")))
        columns.append((a + (b - a) * F.max(at - low)).alias(name))
    found = placed.where(wanted).groupBy(*keys).agg(*columns).select(*[F.col(k).alias(f"_f{k}") for k in keys], *fractions)
    groups = ranged.select(*keys).distinct()
    match = [F.col(k).eqNullSafe(F.col(f"_f{k}")) for k in keys]
    return groups.join(found, match, "left").select(*[F.col(k).alias(c) for k, c in zip(keys, group_cols)], *fractions)
