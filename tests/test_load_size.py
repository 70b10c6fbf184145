"""What a load moves and writes: compressed exports, prints instead of keys, and merges that look at the keys first."""

import pytest
from pyspark.sql import functions as F

from stockflow.lake import PERIOD, Lake
from stockflow.model import SALES
from stockflow.operators import merge, quality
from stockflow.sources import landing
from tests.test_plans import plan

KEYS = ["order_id", "order_date", "product_id"]


def checked_rows(spark, rows):
    """Landed rows of a sales feed with keys and order of versions alone, checked."""
    names = ["order_id", "product_id", "source_file", "erp_export_ts"]
    text = {c: F.lit(None).cast("string") for c in SALES.landing_columns if c not in names}
    text["order_date"] = F.lit("2024-01-01")
    frame = spark.createDataFrame(rows, names).withColumns(text)
    return frame.withColumns({"reasons": F.array().cast("array<string>"), "ingestion_date": F.col("erp_export_ts").cast("timestamp")})


@pytest.mark.parametrize("rebalance", [True, False])
def test_exports_are_compressed_and_read_by_their_headers(spark, tmp_path, rebalance):
    rows = spark.range(40).select(F.col("id").cast("string").alias("order_id"), F.lit('a, "b"').alias("note"))
    at = F.when(F.col("order_id").cast("int") < 10, F.lit("2024-01-01 18:00:00")).otherwise(F.lit("2024-01-02 18:00:00")).cast("timestamp")
    landing.export_csv(rows, str(tmp_path), "sales", at, rebalance=rebalance)
    exports = landing.list_exports(spark, str(tmp_path), "sales")
    assert [e.name for e in exports] == ["sales_20240101_180000.csv", "sales_20240102_180000.csv"]
    files = [f for e in exports for f in landing.part_files(spark, e.path)]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert {landing.header_of(spark, f) for f in files} == {("order_id", "note")}


def test_tasks_of_an_export_do_not_grow_with_the_feed(spark, tmp_path, monkeypatch):
    """More shuffled bytes make more tasks of one size, also beyond the session's shuffle partitions."""
    monkeypatch.setattr(landing, "EXPORT_SPLIT", "64k")
    rows = spark.range(400_000).select((F.col("id") * 7).alias("order_id")).groupBy("order_id").agg(F.max(F.sha2(F.col("order_id").cast("string"), 256)).alias("note"))
    landing.export_csv(rows, str(tmp_path), "sales", F.lit("2024-01-01 18:00:00").cast("timestamp"), rebalance=False)
    (export,) = landing.list_exports(spark, str(tmp_path), "sales")
    assert len(landing.part_files(spark, export.path)) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_only_rows_that_may_share_a_key_are_grouped(spark):
    rows = [("1", "a", "x", "2024-01-01 18:00:00"), ("1", "a", "y", "2024-01-02 18:00:00"), ("2", "a", "x", "2024-01-01 18:00:00"), ("3", "a", "x", "2024-01-01 18:00:00"), ("3", "a", "x", "2024-01-01 18:00:00")]
    checked = checked_rows(spark, rows)
    shared = quality.sharing(checked, SALES)
    assert sorted(r[0] for r in shared.select("order_id").collect()) == ["1", "1", "3", "3"]
    assert quality.sharing(checked.where("order_id = '2'"), SALES).count() == 0
    versions, counts = quality.key_versions(shared, SALES), quality.export_counts(checked, SALES)
    assert not quality.several_versions(versions.where("order_id = '3'")) and quality.several_versions(versions)
    found = {r["source_file"]: tuple(r)[2:] for r in quality.accounting_of(versions, counts).collect()}
    assert found == {"x": (4, 1, 2, 1), "y": (1, 1, 0, 0)}


def test_large_batches_look_at_the_keys_first(spark, monkeypatch):
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    target = spark.range(10).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    for source, joins, expected in (
        (spark.range(12), False, {i: "new" for i in range(12)}),
        (spark.range(20, 25), False, {**{i: "old" for i in range(10)}, **{i: "new" for i in range(20, 25)}}),
        (spark.range(5, 25), True, {**{i: "old" for i in range(5)}, **{i: "new" for i in range(5, 25)}}),
        (spark.range(8, 10), True, {**{i: "old" for i in range(8)}, 8: "new", 9: "new"}),
    ):
        batch = source.select(F.col("id").alias("k"), F.lit("new").alias("v"))
        merged = merge.merge_whole(target, batch, ["k"], batch, batch.count())
        assert ("Join" in plan(merged)) == joins
        assert sorted((r["k"], r["v"]) for r in merged.collect()) == sorted(expected.items())


def test_keys_of_one_print_are_not_repeats(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(0).cast("long"))
    lake = Lake.scratch(spark, "prints")
    rows = spark.sql("SELECT id, DATE '2024-01-01' AS day FROM range(3)")
    merge.upsert(lake, "t", rows.schema, rows, ["id", "day"], "day")
    assert lake.read("t").drop(PERIOD).count() == 3
    with pytest.raises(merge.DuplicateKeys):
        merge.upsert(lake, "t", rows.schema, rows.unionByName(rows.limit(1)), ["id", "day"], "day")


def test_a_large_batch_of_new_keys_adds_files_and_rewrites_none(spark, monkeypatch):
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    lake = Lake.scratch(spark, "added")

    def put(first, last, v):
        rows = spark.sql(f"SELECT id, DATE '2024-01-01' AS day, {v} AS v FROM range({first}, {last})")
        merge.upsert(lake, "t", rows.schema, rows, ["id", "day"], "day")
        return set(lake.read("t").inputFiles())

    before = put(0, 5, 1)
    added = put(5, 8, 2)
    assert before < added
    assert sorted((r.id, r.v) for r in lake.read("t").collect()) == [(i, 1 if i < 5 else 2) for i in range(8)]
    again = put(5, 9, 3)  # as after a write that broke off: rows that are there already are replaced
    assert not again & added
    assert sorted((r.id, r.v) for r in lake.read("t").collect()) == [(i, 1 if i < 5 else 3) for i in range(9)]
