import pytest
from pyspark.sql import functions as F

from medlattice.operators.indexing import dense_index, running_totals


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_dense_index_any_partitioning(spark, parts):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k"))
    idx = dense_index(df, ["k"], "i", num_partitions=parts).collect()
    got = sorted((r.i, r.k) for r in idx)
    want = sorted(set(r.k for r in df.collect()))
    assert [k for _, k in got] == want and [i for i, _ in got] == list(range(len(want)))


@pytest.mark.parametrize("parts", [1, 7])
def test_running_totals(spark, parts):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(50)], "s double, v long")
    r = {x.s: x.cum_v for x in running_totals(df, "s", ["v"], num_partitions=parts).collect()}
    acc = 0
    for i in range(50):
        acc += i % 3
        assert r[float(i)] == acc
    d = {x.s: x.cum_v for x in running_totals(df, "s", ["v"], descending=True, inclusive=False,
                                               num_partitions=parts).collect()}
    assert d[49.0] == 0 and d[0.0] == sum(i % 3 for i in range(1, 50))
