"""A lake: one catalog database whose tables live in a shared folder.

Tables are parquet, partitioned by the period of their date key, and overwritten partition by partition.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.expressions import period_start
from stockflow.session import session_conf

PERIOD = "period"
GRAINS = ("day", "month", "year")
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: Up to so many partitions a task may write a file into each; rows for more are shuffled to them first.
FEW_PARTITIONS = 16
#: What one task of a write reads of files: it sorts its rows by partition, and compressed files grow many times in memory.
WRITE_SPLIT = "32m"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="stockflow-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run, removed when the application ends."""
    path = f"{shared_root(spark).rstrip('/')}/stockflow/{label}-{uuid.uuid4().hex[:12]}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that outlives executors."""
    path = run_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob; an absent folder matches nothing."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(jpath) or []]


def path_bytes(spark: SparkSession, path: str) -> int:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jpath).getLength())


def pick_grain(n_bytes: int, n_days: int) -> str:
    """Finest period whose average partition still reaches the target size."""
    for grain, days in (("day", 1), ("month", 30)):
        if n_bytes * days / max(n_days, 1) >= TARGET_PARTITION_BYTES:
            return grain
    return "year"


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema's columns, in its order and types; other columns are left out."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


class Lake:
    """Named tables in one database; ``Lake.open`` makes the database if it is absent."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark, self.database, self.root = spark, database, root

    @classmethod
    def open(cls, spark: SparkSession, database: str, root: str) -> Lake:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}'")
        return cls(spark, database, root)

    @classmethod
    def scratch(cls, spark: SparkSession, label: str) -> Lake:
        root = run_dir(spark, label)
        return cls.open(spark, "sf_" + root.rsplit("/", 1)[-1].replace("-", "_"), f"{root}/lake")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.table(self.name(table))

    def ensure(self, table: str, schema: T.StructType, partition_by: str | None = None, grain: str = "day") -> str:
        """Create the empty table if it is absent.

        Partition values come from ``partition_by``; a writer replaces only the partitions it has rows for.
        """
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        layout = ""
        if partition_by:
            layout = f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (`{partition_by}`)"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet {layout} "
            f"TBLPROPERTIES ('stockflow.grain' = '{grain}')"
        )
        return self.name(table)

    def ensure_by_date(self, table: str, schema: T.StructType, grain: str = "day") -> str:
        """As ``ensure``, partitioned by the period of the table's date key."""
        return self.ensure(table, T.StructType([*schema, T.StructField(PERIOD, T.DateType())]), PERIOD, grain)

    def property(self, table: str, key: str) -> str | None:
        """A property that the table was given when it was made."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where(F.col("key") == f"stockflow.{key}").first()
        return found["value"] if found else None

    def set_property(self, table: str, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('stockflow.{key}' = '{value}')")

    def grain(self, table: str) -> str:
        return self.property(table, "grain") or "day"

    def period(self, table: str, date_key: str) -> Column:
        return period_start(F.col(date_key), self.grain(table))

    def replace_partitions(self, table: str, df: DataFrame, partition_by: str = PERIOD, rebalance: bool = True) -> None:
        """Overwrite the partitions present in ``df`` and leave the others alone.

        ``rebalance`` shuffles to size the output files and to split a partition that holds much more than the rest. Without it each
        task writes what it has, which is right where a task's rows already belong to one partition or few.
        """
        columns = self.read(table).columns
        with session_conf(self.spark, spark__sql__sources__partitionOverwriteMode="dynamic", spark__sql__files__maxPartitionBytes=WRITE_SPLIT):
            rows = df.select(*columns)
            (rows.hint("rebalance", partition_by) if rebalance else rows).write.mode("overwrite").insertInto(self.name(table))
        self.written(table, df)

    def append(self, table: str, df: DataFrame, rebalance_by: str | None = None) -> None:
        """Add rows. ``rebalance_by`` is the partition column where they are for many partitions."""
        rows = df.select(*self.read(table).columns)
        with session_conf(self.spark, spark__sql__files__maxPartitionBytes=WRITE_SPLIT):
            (rows.hint("rebalance", rebalance_by) if rebalance_by else rows).write.mode("append").insertInto(self.name(table))
        self.written(table, df)

    def written(self, table: str, df: DataFrame) -> None:
        """Forget which files the table had. A write does so in the session of its rows, which for a micro-batch is not the lake's."""
        if df.sparkSession is not self.spark:
            self.spark.catalog.refreshTable(self.name(table))

    def drop_partitions(self, table: str, column: str, times: Sequence[datetime]) -> None:
        if not times:
            return
        listed = ", ".join(f"PARTITION ({column} = TIMESTAMP '{t.isoformat(' ')}')" for t in times)
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {listed}")

    def drop_labels(self, table: str, column: str, labels: Sequence[str]) -> None:
        """Drop partitions by the text of their value; those that are not there are passed over."""
        if not labels:
            return
        listed = ", ".join("PARTITION ({} = '{}')".format(column, label.replace("'", "\\'")) for label in labels)
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {listed}")

    def partitions(self, table: str, column: str) -> DataFrame:
        """Partition values from the catalog only; no data file is opened."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        value = F.url_decode(F.regexp_extract("partition", f"{column}=([^/]*)", 1))
        return listed.select(value.alias(column))
