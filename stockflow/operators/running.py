"""Running sums and group totals that survive a key holding a large part of all rows.

Ordinary keys use a plain window: one shuffle, one sort. A window would put all rows of a key into one task, so keys
above ``hot_rows`` take a second, exact way:

* their rows are range-partitioned by key *and* order, which spreads one key over many tasks, and written with
  the number of their slice;
* each slice's sum per key is small; a window over those gives what every slice starts from;
* the rows add up within their slice, starting from there.

Both ways give the same sums, so it does not matter if a key of about ``hot_rows`` rows goes the one way or the other: hot keys are found in a thin
sample, without a shuffle of all keys. About ``2 * rows / hot_rows`` keys can be taken for hot, so the list of them is small; the adaptive planner picks the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.lake import materialise

HOT_ROWS = 2_000_000
SLICE = "_slice"
#: Rows of a hot key that the sample is expected to hold.
SAMPLED = 400


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys that seem to hold more than ``hot_rows`` rows: in the sample they have at least half of what such a key has there."""
    share = min(1.0, SAMPLED / hot_rows)
    sampled, least = (df.select(*keys), hot_rows) if share == 1.0 else (df.select(*keys).sample(share, seed=1), hot_rows * share / 2)
    return sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least).select(*keys)


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys, and those of hot keys (None if there is no hot key).

    NULL keys form one group, as in a window, so they are compared null-safe.
    """
    renamed = [F.col(k).alias(f"_hot_{k}") for k in keys]
    hot = materialise(hot_keys(df, keys, hot_rows).select(*renamed), "hot-keys")
    if hot.isEmpty():
        return df, None
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the key up to and including this one.

    ``order`` must be a total order within a key. ``slices`` (default: the shuffle partitions) is the number of
    ranges the rows of hot keys are cut into.
    """
    frame = Window.partitionBy(*keys).orderBy(*_ascending(order)).rowsBetween(Window.unboundedPreceding, 0)
    ordinary, hot = split_hot(df, keys, hot_rows)
    result = ordinary.withColumn(out, F.sum(value).over(frame))
    if hot is None:
        return result

    # The slice number is only stable once it is written: a lost task could otherwise cut the ranges anew.
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = hot.repartitionByRange(slices, *_ascending([*keys, *order])).withColumn(SLICE, F.spark_partition_id())
    sliced = materialise(sliced, "hot-slices")
    sums = sliced.groupBy(*keys, SLICE).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(k).alias(f"_start_{k}") for k in keys],
        F.col(SLICE).alias("_start_slice"),
        F.sum("_sum").over(before).alias("_before"),
    )
    same = F.col(SLICE) == F.col("_start_slice")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_start_{k}"))
    within = (
        Window.partitionBy(*keys, SLICE).orderBy(*_ascending(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    # A NULL sum (only NULL values so far) stays NULL; a sum on either side counts alone.
    here, carried = F.sum(value).over(within), F.col("_before")
    total = F.coalesce(here + carried, here, carried).cast(result.schema[out].dataType)
    summed = sliced.join(starts, same, "left").withColumn(out, total)
    return result.unionByName(summed.select(*result.columns))


def group_total(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``out`` = sum of ``value`` over all rows of the key, on every row.

    Hot keys are summed with partial aggregation and their few totals are joined back to the rows.
    """
    ordinary, hot = split_hot(df, keys, hot_rows)
    result = ordinary.withColumn(out, F.sum(value).over(Window.partitionBy(*keys)))
    if hot is None:
        return result
    totals = hot.groupBy(*[F.col(k).alias(f"_total_{k}") for k in keys]).agg(F.sum(value).alias(out))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_total_{k}"))
    summed = hot.join(totals, same)  # one row per hot key
    return result.unionByName(summed.select(*result.columns))
