"""Plans: what reaches the scan, which joins are chosen, and what must never appear."""

import pytest
from pyspark.sql import functions as F

from stockflow.lake import PERIOD, Lake
from stockflow.operators import merge, quality
from stockflow.queries import checks, live, loading, planning
from stockflow.queries import marts as mart_queries
from stockflow.sources.domain import Domain

SF_DIR = "/root/testdata/sf0.001"
LAZY = {**mart_queries.QUERIES, **{n: q for n, q in checks.QUERIES.items() if n not in ("ingest_monitoring", "rejected_rows")}}


#: Queries that write tables and return a reading of them; what they return must be free of these too.
WRITING = {**planning.QUERIES, "stream_late": live.QUERIES["stream_late"], "schema_drift": loading.QUERIES["schema_drift"]}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_cross_join_and_no_python(name, spark):
    text = plan(LAZY[name][0](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert banned not in text


@pytest.mark.parametrize("name", sorted(WRITING))
def test_no_cross_join_and_no_python_in_what_is_returned(name, spark):
    text = plan(WRITING[name][0](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert banned not in text


def test_a_load_counts_its_keys_before_they_are_shuffled(spark):
    frame = spark.createDataFrame([("1", "2024-01-01", "p", "f", [])], "order_id string, order_date string, product_id string, source_file string, reasons array<string>")
    frame = frame.withColumns({"ingestion_date": F.lit(None).cast("timestamp"), **{c: F.lit("1") for c in loading.SALES.latest_by}})
    text = plan(quality.key_versions(frame, loading.SALES))
    assert text.count("Exchange hashpartitioning") == 2 and "partial_count" in text and "Window" not in text


def test_day_filter_is_pushed_as_a_range(spark):
    text = plan(mart_queries.silver_day_filter(spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "LessThan(ts,2024-01-16" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(mart_queries.fulfilment(spark, SF_DIR))
    for unused in ("l_extendedprice", "l_shipdate", "l_tax", "l_discount"):
        assert unused not in text


def test_dimensions_are_broadcast_only_within_their_size(spark):
    small, large = Domain(spark, SF_DIR), Domain(spark, SF_DIR, broadcast_bytes=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for d, joins in ((small, "BroadcastHashJoin"), (large, "SortMergeJoin")):
            text = plan(d.order_lines().join(d.suppliers(), "supplier_id"))
            assert text.index(joins) < text.index("l_orderkey")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_are_not_shuffled_on_locations(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        for query in (mart_queries.daily_sales, mart_queries.dense_demand, mart_queries.ledger):
            text = plan(query(spark, SF_DIR))
            assert "hashpartitioning(location_id" not in text and "hashpartitioning(supplier_id" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_reads_only_the_periods_of_the_batch(spark):
    d, lake = Domain(spark, SF_DIR), Lake.scratch(spark, "plan")
    merge.upsert(lake, "orders", loading.ORDER_SCHEMA, loading.known_orders(d), loading.ORDER_KEYS, "order_date", grain="year")
    target = lake.read("orders").where(F.col(PERIOD).isin(["1996-01-01"]))
    text = plan(merge.merge_rows(target, target, loading.ORDER_KEYS))
    assert f"PartitionFilters: [isnotnull({PERIOD}" in text
    assert len(target.inputFiles()) < len(lake.read("orders").inputFiles())


def test_small_batch_is_broadcast_into_the_merge(spark):
    """The target of an anti join with a small batch is not shuffled."""
    d, lake = Domain(spark, SF_DIR), Lake.scratch(spark, "plan2")
    merge.upsert(lake, "orders", loading.ORDER_SCHEMA, loading.known_orders(d), loading.ORDER_KEYS, "order_date", grain="year")
    text = plan(merge.merge_rows(lake.read("orders"), loading.order_rows(d).withColumn(PERIOD, F.col("order_date")), loading.ORDER_KEYS))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_monitoring_counts_before_the_shuffle(spark):
    frame = spark.createDataFrame([(1, "f", [])], "order_id int, source_file string, reasons array<string>").withColumn("ingestion_date", F.lit(None).cast("timestamp"))
    frame = frame.withColumns({"order_date": F.lit("x"), "product_id": F.lit("y")})
    text = plan(quality.monitoring_rows(frame, loading.SALES))
    assert text.count("HashAggregate") >= 2 and "partial_count" in text

