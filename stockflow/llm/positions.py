"""Places of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.lake import materialise


def placed(rows: DataFrame, order: Sequence[str], sums: dict[str, str], label: str, group: str | None = None) -> DataFrame:
    """``rows`` with, for each ``name: column`` of ``sums``, the sum of the column over the rows before this one in its group.

    The rows are range-partitioned by group and ``order`` and written, so that a row's range is settled whatever tasks are lost; sums within a
    range and sums of whole ranges are then two small windows. A group or a key that holds most rows is cut into many ranges:
    rows that agree in group and order are told apart by their place in the input, and may swap places with each other only. The result
    does not depend on where ranges end. ``group`` must not be null; nulls in ``order`` come first.
    """
    keys = [group] if group else []
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order, "_tie"]]
    told_apart = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = materialise(told_apart.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), label)
    within = Window.partitionBy("_range", *keys).orderBy(*by[len(keys) :]).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ranges = ranged.groupBy(*keys, "_range").agg(*[F.sum(F.col(c).cast("long")).alias(f"_{name}") for name, c in sums.items()])
    starts = ranges.select(*keys, "_range", *[F.coalesce(F.sum(f"_{name}").over(before), zero).alias(f"_{name}") for name in sums])
    inside = ranged.withColumns({name: F.coalesce(F.sum(F.col(c).cast("long")).over(within), zero) for name, c in sums.items()})
    joined = inside.join(starts, [*keys, "_range"]).withColumns({name: F.col(name) + F.col(f"_{name}") for name in sums})
    return joined.select(*rows.columns, *sums)
