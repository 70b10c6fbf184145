"""Joins with many keys: rows that cannot have one of them are not shuffled, and the bits change no result."""

import pytest
from pyspark.sql import functions as F

from stockflow.lake import PERIOD, Lake
from stockflow.model import SALES
from stockflow.operators import filters, marts, merge, quality
from stockflow.queries import live
from tests.test_plans import plan


@pytest.fixture(params=[2**29, 8])
def bits(request, monkeypatch):
    """Enough bits, and so few that most rows pass by chance."""
    monkeypatch.setattr(filters, "MOST_BITS", request.param)
    monkeypatch.setattr(filters, "BITMAP", min(filters.BITMAP, request.param))


def numbered(spark, n):
    return spark.range(n).select(F.when(F.col("id") > 0, F.concat(F.lit("p"), "id")).alias("k"), "id")


def test_split_and_anti_join_with_many_keys(spark, bits):
    rows = numbered(spark, 1000)
    keys = rows.where("id % 10 = 3").select("k")
    may, others = filters.split(rows, [F.col("k")], keys, ["k"])
    assert others.where("id % 10 = 3").count() == 0
    assert may.count() + others.count() == 1000
    left = filters.without(rows, keys, ["k"])
    assert sorted(r["id"] for r in left.collect()) == [i for i in range(1000) if i % 10 != 3]
    assert filters.without(rows, keys.limit(0), ["k"]).count() == 1000


def test_rows_without_the_keys_are_not_shuffled(spark):
    rows = numbered(spark, 1000)
    _, others = filters.split(rows, [F.col("k")], rows.where("id % 10 = 3").select("k"), ["k"])
    text = plan(others)
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_unknown_references_are_found_by_value(spark, bits):
    rows = spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 7 > 0, (F.col("id") % 50).cast("string")).alias("product_id"), (F.col("id") % 3).cast("string").alias("customer_id"), F.lit("here").alias("location_id")
    )
    parents = {
        "products": spark.range(40).select(F.col("id").alias("product_id")),
        "customers": spark.createDataFrame([(0,), (1,), (1,)], "customer_id long"),
    }
    found = {r["id"]: r["reasons"] for r in quality.with_unknown(rows, SALES, parents).collect()}
    assert len(found) == 300
    for i, why in found.items():
        assert why == ["unknown:customer_id"] * (i % 3 == 2) + ["unknown:product_id"] * (i % 7 > 0 and i % 50 >= 40), i


def test_newest_version_of_the_keys_that_repeat(spark, bits):
    lake = Lake.scratch(spark, "versions")
    rows = spark.sql("SELECT id % 80 AS k, DATE '2024-01-01' AS day, id AS v FROM range(100)")
    again = rows.groupBy("k", "day").count().where("count > 1").drop("count")
    schema = rows.schema
    merge.upsert(lake, "t", schema, rows, ["k", "day"], "day", "latest", ["v"], repeated=True, repeated_keys=again)
    assert sorted((r["k"], r["v"]) for r in lake.read("t").drop(PERIOD).collect()) == [(k, k + 80 if k < 20 else k) for k in range(80)]


def test_products_that_repeat_multiply_the_feed_but_not_its_sums(spark, tmp_path):
    from stockflow.sources.domain import Domain

    source = "/root/testdata/sf0.001"
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{source}/{name}.parquet")
    part = spark.read.parquet(f"{source}/part.parquet")
    part.unionByName(part.where("p_partkey % 2 = 0")).write.parquet(str(tmp_path / "part.parquet"))
    once, twice = (Domain(spark, d).sales_feed().groupBy("order_id", "product_id", "sku", "qty_ordered").count() for d in (source, str(tmp_path)))
    joined = once.withColumnRenamed("count", "n").join(twice, ["order_id", "product_id", "sku", "qty_ordered"], "full")
    even = F.col("product_id").cast("long") % 2 == 0
    assert joined.where(F.col("n").isNull() | F.col("count").isNull() | (F.col("count") != F.when(even, 2).otherwise(1))).count() == 0


def test_whole_rows_of_the_feed_are_not_shuffled_on_the_product(spark):
    from stockflow.sources.domain import Domain

    from stockflow.session import session_conf

    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(Domain(spark, "/root/testdata/sf0.001").sales_feed())
    lines = [line for line in text.splitlines() if "Exchange hashpartitioning(product_id" in line or "Exchange hashpartitioning(l_partkey" in line]
    assert "customer_name" in text
    last = max(text.find("Exchange hashpartitioning(order_id"), text.find("hashpartitioning(l_orderkey"))
    assert lines and last >= 0 and text.find("customer_name") < text.find(lines[0])


def test_derived_movements_are_written_where_they_are(spark):
    lake = Lake.scratch(spark, "derived")
    text = {c: F.lit("x") for c in marts.LEDGER_COLUMNS if c not in ("movement_id", "movement_type")}
    rows = spark.range(80, numPartitions=4).select(F.col("id").cast("string").alias("movement_id"), F.when(F.col("id") % 2 == 0, "sale").otherwise("po_receipt").alias("movement_type")).withColumns(text)
    for _ in range(2):
        marts.store_derived(lake, "moves", rows)
    assert lake.read("moves").count() == 80
    assert len(lake.read("moves").inputFiles()) == 8  # two types, four tasks; a shuffle would leave a file a type


def test_streamed_sides_are_made_once(spark):
    sold, moved = live.sold_and_moved(spark, "/root/testdata/sf0.001")
    for side in (sold, moved):
        text = plan(side)
        assert "Join" not in text and "Exchange" not in text
