"""Reference data from the operational database, and its reads as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A JDBC relation: filters and columns are pushed down, and a numeric key splits the read over executors."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch_size), **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def active_only(df: DataFrame, flag: str = "is_active") -> DataFrame:
    return df.where(F.col(flag))


def available_stock(inventory: DataFrame, locations: DataFrame, location_type: str = "sanicenter") -> DataFrame:
    """Stock that can be sold: at a sales location, in stock, and not all of it reserved."""
    selling = locations.where(F.col("location_type") == location_type).select("location_id", "location_name")
    in_stock = inventory.where((F.col("qty_on_hand") > 0) & (F.col("qty_on_hand") > F.col("qty_reserved")))
    return in_stock.join(selling, "location_id")


def open_purchase_lines(orders: DataFrame, lines: DataFrame, statuses: tuple[str, ...] = ("sent", "confirmed")) -> DataFrame:
    """Purchase order lines that still wait for goods."""
    waiting = orders.where(F.col("status").isin(*statuses))
    return waiting.join(lines.where(F.col("qty_received") < F.col("qty_ordered")), "po_id")
