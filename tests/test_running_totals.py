"""Running totals above the size at which range bounds are sampled."""

import pytest
from pyspark.sql import functions as F

from medlattice.operators import metrics


@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_auc_of_many_scores_equals_the_closed_form(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        n = 200_000
        # score i is positive if i mod 3 = 0 or i >= n / 2
        df = spark.range(n).select(F.col("id").cast("double").alias("score"),
                                   ((F.col("id") % 3 == 0) | (F.col("id") >= n // 2)).cast("int").alias("label"))
        negatives = wins = positives = 0
        for i in range(n):
            if i % 3 == 0 or i >= n // 2:
                positives += 1
                wins += negatives
            else:
                negatives += 1
        assert metrics.roc_auc(df).first()["auc"] == pytest.approx(wins / (positives * negatives), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
