"""A key, a date or a source that holds a third of all rows must not end up in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockflow.lake import PERIOD, Lake
from stockflow.model import SALES
from stockflow.operators import merge, quality
from stockflow.session import session_conf

SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Order lines, a third of them of order 0, as written files."""
    path = str(tmp_path_factory.mktemp("skew") / "lines")
    order = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    spark.range(0, 90_000, 1, 12).select(order.alias("order_id"), F.col("id").alias("line_no"), F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "orders")
    spark.range(5000).select(F.col("id").alias("order_id"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 9).cast("int")).alias("order_date")).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_in_a_join_even_before_an_aggregate_on_it(spark, lines, orders):
    with session_conf(spark, **SMALL):
        joined = lines.join(orders, "order_id").groupBy("order_id", "order_date").agg(F.count("*").alias("n"), F.max("text").alias("t"))
        rows, text = final_plan(joined)
        assert sum(r["n"] for r in rows) == 90_000
        assert "skew=true" in text


@pytest.mark.parametrize("name", ["merge", "foreign_key"])
def test_hot_key_is_split_in_an_anti_join(spark, lines, orders, name):
    with session_conf(spark, **SMALL):
        if name == "merge":
            kept = merge.merge_rows(lines, lines.limit(0), ["order_id", "line_no"])
        else:
            kept = quality.foreign_key_violations(lines, "order_id", orders.where("order_id > 10"), "order_id")
        rows, text = final_plan(kept.agg(F.count("*").alias("n")))
        want = 90_000 if name == "merge" else lines.where("order_id <= 10").count()
        assert rows[0]["n"] == want
        assert name == "merge" or "skew=true" in text


def test_latest_row_of_a_hot_key_leaves_each_task_once(spark, lines):
    best = merge.latest_per_key(lines, ["order_id"], ["line_no"])
    rows, text = final_plan(best)
    assert {r["order_id"]: r["line_no"] for r in rows}[0] == 89_997
    partial = text.index("WindowGroupLimit", text.index("Exchange hashpartitioning(order_id"))
    assert "Partial" in text[partial : partial + 400]


def test_hot_partition_is_written_as_several_files(spark):
    lake = Lake.scratch(spark, "hot")
    day = F.when(F.col("id") % 3 != 0, dt.date(2024, 1, 1)).otherwise(F.date_add(F.lit("2024-01-02"), (F.col("id") % 9).cast("int")))
    rows = spark.range(0, 60_000, 1, 8).select(F.col("id"), day.alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200k"):
        merge.upsert(lake, "t", rows.schema, rows, ["id", "day"], "day")
    hot = lake.read("t").where(F.col(PERIOD) == dt.date(2024, 1, 1))
    assert hot.count() == 40_000 and len(hot.inputFiles()) > 3
    assert lake.read("t").count() == 60_000


def test_hot_source_is_counted_before_the_shuffle(spark):
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "f0").otherwise(F.concat(F.lit("f"), (F.col("id") % 50).cast("string"))).alias("source_file"),
        F.lit(None).cast("timestamp").alias("ingestion_date"),
        *[F.lit("k").alias(k) for k in SALES.keys],
        F.array().cast("array<string>").alias("reasons"),
    )
    counted, text = final_plan(quality.monitoring_rows(rows, SALES))
    assert sum(r["rows"] for r in counted) == 30_000 * len(SALES.keys)
    assert "partial_count" in text
