import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockflow.operators.running import group_total, running_sum


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, some ordinary ones, a NULL key, NULL values."""
    rng = random.Random(3)
    rows = [(1, i) for i in range(3000)] + [(k, i) for k in range(2, 40) for i in range(20)] + [(None, i) for i in range(600)]
    rows = [(k, i // 7, i, None if rng.random() < 0.1 else rng.randint(-50, 50)) for k, i in rows]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, day int, seq int, v int").withColumn("v", F.col("v").cast("decimal(12,2)")).cache()


@pytest.mark.parametrize("hot_rows", [10, 500, 2500, 10**9])
def test_running_sum_is_exact_for_hot_and_ordinary_keys(skewed, hot_rows):
    got = running_sum(skewed, ["k"], ["day", "seq"], "v", "total", hot_rows)
    frame = Window.partitionBy("k").orderBy("day", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("total", F.sum("v").over(frame))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_is_spread_over_slices(spark, skewed):
    """The hot path cuts one key into slices of its own order, so no task holds all of it."""
    hot = skewed.where("k = 1").repartitionByRange(8, "k", "day", "seq")
    sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


@pytest.mark.parametrize("hot_rows", [10, 500, 10**9])
def test_group_total(skewed, hot_rows):
    got = group_total(skewed, ["k"], "v", "total", hot_rows)
    want = skewed.withColumn("total", F.sum("v").over(Window.partitionBy("k")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
