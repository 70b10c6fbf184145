"""What the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.lake import TARGET_PARTITION_BYTES, path_bytes, pick_grain
from stockflow.plans.gold_tables import BUCKETS
from stockflow.sources.domain import Domain


STATE_BYTES = 16 * 1024 * 1024


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals are shown as doubles, after all arithmetic is done."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def as_plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def grain_for(domain: Domain, table: str, date_column: str) -> str:
    """Partition grain for data of one table, from its size and the days it spans."""
    first, last = domain.table(table).agg(F.min(date_column), F.max(date_column)).first()
    days = (last - first).days + 1 if first is not None else 1
    return pick_grain(path_bytes(domain.spark, domain.path(table)), days)


def buckets_for(domain: Domain, table: str) -> int:
    """Buckets for a table of totals over the rows of ``table``: none smaller than a good file."""
    return max(1, min(BUCKETS, path_bytes(domain.spark, domain.path(table)) // TARGET_PARTITION_BYTES))


def state_partitions(domain: Domain, *tables: str) -> int:
    """State partitions for streams over tables: none much smaller than 16 MB of them, and no more than the session shuffles into."""
    size = sum(path_bytes(domain.spark, domain.path(t)) for t in tables)
    most = int(domain.spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(4, size // STATE_BYTES))
