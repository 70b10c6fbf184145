"""Landing, raw, Bronze, Silver and merge operators over data that Spark derives from the tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import PERIOD, Lake, materialise
from stockflow.model import MOVEMENTS, SALES, TableSpec
from stockflow.operators import marts, merge, quality
from stockflow.plans import gold_tables, job, layers
from stockflow.queries import sql
from stockflow.queries.common import as_doubles, as_plain_time, buckets_for, grain_for
from stockflow.sources import landing
from stockflow.sources.domain import OPENING_TIME, Domain

SINCE = "1998-01-01 18:00:00"
FIRST_RUN, SECOND_RUN, THIRD_RUN = "2025-01-06 18:05:00", "2025-01-07 18:05:00", "2025-01-08 18:05:00"
SALES_TIMES = ("order_ts", "erp_export_ts")


def export_time(day: Column) -> Column:
    """The simulated system exports once per year of orders, at six in the evening of the first day."""
    return F.date_trunc("year", day.cast("timestamp")) + F.expr("INTERVAL 18 HOURS")


def export_sales(spark: SparkSession, sf_dir: str, label: str, feed: DataFrame | None = None) -> tuple[Lake, str]:
    """A fresh lake and a landing folder with the whole sales feed."""
    lake = Lake.scratch(spark, label)
    landing_dir = f"{lake.root}-landing"
    rows = feed if feed is not None else Domain(spark, sf_dir).sales_feed()
    landing.export_csv(rows, landing_dir, SALES.name, export_time(F.col("order_date")), rebalance=False)
    return lake, landing_dir


def landed(spark: SparkSession, landing_dir: str, spec: TableSpec, since: str | None = None) -> DataFrame:
    return landing.read_landing(spark, spec, landing.list_exports(spark, landing_dir, spec.name, since))


def movement_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movement export, from sales: one flat row per movement id, so lines that agree in all parts of it are one movement."""
    d = Domain(spark, sf_dir)
    moved = ["order_id", "line_no", "product_id", "supplier_id", "location_id", "order_ts", "order_date"]
    lines = d.sale_lines().where(F.col("qty_fulfilled") > 0).groupBy(*moved).agg(F.sum("qty_fulfilled").alias("qty_fulfilled"))
    placed = lines.join(d.locations().select("location_id", "location_code"), "location_id")
    stamp = "yyyy-MM-dd HH:mm:ss"
    return placed.select(
        F.concat_ws("-", F.lit("sale"), "order_id", "line_no", "product_id", "supplier_id").alias("movement_id"),
        F.date_format("order_ts", stamp).alias("movement_ts"),
        F.col("order_date").alias("movement_date"),
        F.lit("sale").alias("movement_type"),
        F.col("product_id").cast("string").alias("product_id"),
        F.format_string("SKU-%05d", "product_id").alias("sku"),
        F.col("location_id").cast("string").alias("location_id"),
        "location_code",
        (-F.col("qty_fulfilled")).alias("qty_delta"),
        F.col("order_id").cast("string").alias("ref_order_id"),
        F.lit("sales_order").alias("ref_order_type"),
        F.lit('Sale, "as fulfilled"\nby line').alias("notes"),
        F.date_format(F.col("order_ts") + F.expr("INTERVAL 18 HOURS"), stamp).alias("erp_export_ts"),
    )


def all_movements_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movement export with all types: the ledger's opening stock, sales and receipts, and counts and transfers derived from the stock."""
    d = Domain(spark, sf_dir)
    stock = d.inventory()
    place = (F.col("product_id") + F.col("location_id")) % 10
    counted = F.array(
        F.when(place == 0, derived_movement("adjustment", -1, "Cycle count correction", "1998-06-30 12:00:00")),
        F.when(place == 5, derived_movement("transfer", 5, "Transfer to the next location", "1998-09-30 12:00:00")),
    )
    moved = marts.movement_ledger(stock, d.traded_lines(), OPENING_TIME).unionByName(stock.select(F.inline(F.array_compact(counted))))
    whole = [c for c in marts.LEDGER_COLUMNS if c != "qty_delta"]
    summed = moved.groupBy(*whole).agg(F.sum("qty_delta").alias("qty_delta"))  # equal lines of an order are one movement
    placed = summed.join(d.locations().select("location_id", "location_code"), "location_id")
    stamp = "yyyy-MM-dd HH:mm:ss"
    return placed.select(
        "movement_id",
        F.date_format("movement_ts", stamp).alias("movement_ts"),
        F.col("movement_ts").cast("date").alias("movement_date"),
        "movement_type",
        F.col("product_id").cast("string").alias("product_id"),
        F.format_string("SKU-%05d", "product_id").alias("sku"),
        F.col("location_id").cast("string").alias("location_id"),
        "location_code",
        "qty_delta",
        F.col("ref_order_id").cast("string").alias("ref_order_id"),
        "ref_order_type",
        "notes",
        F.date_format(F.col("movement_ts") + F.expr("INTERVAL 18 HOURS"), stamp).alias("erp_export_ts"),
    )


def derived_movement(kind: str, qty: int, notes: str, at: str) -> Column:
    return F.struct(
        F.concat_ws("-", F.lit(kind), "product_id", "location_id").alias("movement_id"),
        F.col("product_id"),
        F.col("location_id"),
        F.lit(kind).alias("movement_type"),
        F.lit(qty).cast("decimal(13,2)").alias("qty_delta"),
        F.lit(None).cast("bigint").alias("ref_order_id"),
        F.lit(kind).alias("ref_order_type"),
        F.lit(at).cast("timestamp_ntz").alias("movement_ts"),
        F.lit(notes).alias("notes"),
    )


def incremental_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, landing_dir = export_sales(spark, sf_dir, "incremental")
    batch = landed(spark, landing_dir, SALES, SINCE)
    return batch.select("order_id", "product_id", "order_date", "line_total_eur", "source_file")


def feed_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds land in one folder; each reader gets its own."""
    lake, landing_dir = export_sales(spark, sf_dir, "routing")
    landing.export_csv(movement_feed(spark, sf_dir), landing_dir, MOVEMENTS.name, export_time(F.col("movement_date")), rebalance=False)
    counted = [
        landed(spark, landing_dir, spec)
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("feed", F.lit(spec.name))
        for spec in (SALES, MOVEMENTS)
    ]
    return counted[0].unionByName(counted[1])


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, landing_dir = export_sales(spark, sf_dir, "csv")
    batch = landed(spark, landing_dir, SALES)
    typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES.landing_schema()])
    return as_plain_time(typed, *SALES_TIMES)


def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas and signs survive writing and reading the movement feed."""
    lake = Lake.scratch(spark, "export")
    landing_dir = f"{lake.root}-landing"
    landing.export_csv(movement_feed(spark, sf_dir), landing_dir, MOVEMENTS.name, export_time(F.col("movement_date")), rebalance=False)
    batch = landed(spark, landing_dir, MOVEMENTS)
    typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MOVEMENTS.landing_schema()])
    return as_plain_time(typed, "movement_ts", "erp_export_ts")


def land_twice(spark: SparkSession, sf_dir: str, label: str) -> Lake:
    lake, landing_dir = export_sales(spark, sf_dir, label)
    for since in (None, SINCE):
        landing.write_raw(lake, SALES, quality.check_raw(landed(spark, landing_dir, SALES, since), SALES))
    return lake


def raw_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing a part of the exports again replaces their partitions and adds nothing."""
    raw = landing.read_raw(land_twice(spark, sf_dir, "raw"), SALES)
    return as_plain_time(raw, "ingestion_date").select(
        "order_id", "product_id", "order_date", "qty_ordered", "line_total_eur", "ingestion_date"
    )


def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = landing.read_latest(land_twice(spark, sf_dir, "latest"), SALES)
    return as_plain_time(latest, "ingestion_date").select("order_id", "product_id", "order_date", "sku", "ingestion_date")


def bronze_lake(spark: SparkSession, sf_dir: str, label: str) -> Lake:
    lake, landing_dir = export_sales(spark, sf_dir, label)
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain)
    return lake


def shown(df: DataFrame) -> DataFrame:
    return as_plain_time(df.drop(PERIOD), *SALES_TIMES, "processed_date")


def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps up to Bronze, run twice: the second run replaces every row by itself."""
    lake, landing_dir = export_sales(spark, sf_dir, "bronze")
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    for moment in (FIRST_RUN, SECOND_RUN):
        layers.load_bronze(lake, SALES, landing_dir, moment, grain=grain)
    return shown(lake.read(layers.bronze_table(SALES)))


def silver_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to Silver by changed periods; a second run of Bronze over part of the exports is caught up."""
    lake, landing_dir = export_sales(spark, sf_dir, "silver")
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    for moment, since in ((FIRST_RUN, None), (SECOND_RUN, SINCE)):
        layers.load_bronze(lake, SALES, landing_dir, moment, since, grain=grain)
        layers.promote_silver(lake, SALES, grain=grain)
    return shown(as_doubles(lake.read(layers.silver_table(SALES)), *SALES.money))


def repeated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales feed with faults: orders whose number ends in 0 come twice in their export, with another total the second time, and some values do not fit."""
    feed = Domain(spark, sf_dir).sales_feed()
    last = F.col("order_id").cast("long") % 10
    total = F.when(last == 1, "99999999999").when(last == 2, "NaN").otherwise(F.col("order_total_eur").cast("string"))
    totals = F.when(last == 0, F.array(F.col("line_total_eur"), F.col("line_total_eur") + 1)).otherwise(F.array("line_total_eur"))
    return feed.withColumns({"order_total_eur": total, "line_total_eur": F.explode(totals)})


def corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later versions of orders whose number ends in 3, as another export of their year."""
    feed = Domain(spark, sf_dir).sales_feed().where(F.col("order_id").cast("long") % 10 == 3)
    later = F.date_format(F.col("erp_export_ts").cast("timestamp") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")
    return feed.withColumns({"line_total_eur": F.col("line_total_eur") + 2, "erp_export_ts": later})


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per export: landed = accepted + rejected + superseded, with repeated keys, values that do not fit and two versions of some orders."""
    lake, landing_dir = export_sales(spark, sf_dir, "reconcile", repeated_feed(spark, sf_dir))
    landing.export_csv(corrected(spark, sf_dir), landing_dir, SALES.name, export_time(F.col("order_date")) + F.expr("INTERVAL 1 HOUR"), rebalance=False)
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain_for(Domain(spark, sf_dir), "orders", "o_orderdate"))
    return lake.read(layers.ACCOUNTING_TABLE).drop("date")


def incompatible_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports without a column that the table needs are rejected as a whole; the others of the batch land."""
    lake, landing_dir = export_sales(spark, sf_dir, "headers")
    lacking = Domain(spark, sf_dir).sales_feed().drop("sku")
    landing.export_csv(lacking, landing_dir, SALES.name, export_time(F.col("order_date")) + F.expr("INTERVAL 1 HOUR"), rebalance=False)
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain_for(Domain(spark, sf_dir), "orders", "o_orderdate"))
    return lake.read(layers.ACCOUNTING_TABLE).drop("date")


def drifting_feed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The sales feed as four systems write it into one export: as agreed, in another order with a new column, with a column by its other name, and without one."""
    feed = Domain(spark, sf_dir).sales_feed()
    last = F.col("order_id").cast("long") % 4
    channel = feed.where(last == 1).withColumn("channel", F.concat(F.lit("via, "), F.col("source")))
    return [
        feed.where(last == 0),
        channel.select(*reversed(channel.columns)),
        feed.where(last == 2).withColumnRenamed("qty_ordered", "quantity"),
        feed.where(last == 3).withColumnRenamed("line_total_eur", "amount"),
    ]


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files of one export by their own headers: accepted lines with what the table has no column for, and refused lines by export."""
    lake = Lake.scratch(spark, "drift")
    landing_dir = f"{lake.root}-landing"
    spec = replace(SALES, aliases={"quantity": "qty_ordered"})
    for part in drifting_feed(spark, sf_dir):
        landing.export_csv(part, landing_dir, SALES.name, export_time(F.col("order_date")), rebalance=False)
    layers.load_bronze(lake, spec, landing_dir, FIRST_RUN, grain=grain_for(Domain(spark, sf_dir), "orders", "o_orderdate"))
    raw = lake.read(landing.raw_table(spec)).where(F.size("reasons") == 0)
    kept = raw.select(
        F.concat_ws("-", "order_id", "product_id").alias("line"), F.col("qty_ordered").cast("double").alias("qty_ordered"), F.col(landing.RESCUED)["channel"].alias("channel"), F.lit("").alias("reason"), F.lit(1).cast("long").alias("n")
    )
    refused = lake.read(layers.rejected_table(spec)).groupBy(F.col("source_file").alias("line"), F.array_join("reasons", ",").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    none = {"qty_ordered": F.lit(None).cast("double"), "channel": F.lit(None).cast("string")}
    return kept.unionByName(refused.withColumns(none))


def silver_unfit_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What Silver cannot hold is rejected while landing, with the reason, and blocks nothing: rejected keys, and the keys in Silver."""
    lake, landing_dir = export_sales(spark, sf_dir, "unfit", repeated_feed(spark, sf_dir))
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain)
    layers.promote_silver(lake, SALES, grain=grain)
    rejected = lake.read(layers.rejected_table(SALES)).select("order_id", "product_id", F.array_join("reasons", ",").alias("reason"))
    return lake.read(layers.silver_table(SALES)).select("order_id", "product_id", F.lit("").alias("reason")).unionByName(rejected)


def silver_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of the same and of an older moment after a promotion, and a promotion that broke off before it was noted: nothing is left behind."""
    lake, landing_dir = export_sales(spark, sf_dir, "backfill")
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    layers.load_bronze(lake, SALES, landing_dir, SECOND_RUN, SINCE, grain=grain)
    layers.promote_silver(lake, SALES, grain=grain)
    layers.load_bronze(lake, SALES, landing_dir, SECOND_RUN, "1996-06-01 00:00:00", grain=grain)
    lake.spark.sql(f"DROP TABLE {lake.name(layers.promoted_table(SALES))}")  # as if the note had not been written
    layers.promote_silver(lake, SALES, grain=grain)
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain)
    layers.promote_silver(lake, SALES, grain=grain)
    return as_doubles(lake.read(layers.silver_table(SALES)).select("order_id", "product_id", "order_date", "line_total_eur"), "line_total_eur")


def silver_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movement feed with all five types from landing to Silver."""
    lake = Lake.scratch(spark, "movements")
    landing_dir = f"{lake.root}-landing"
    landing.export_csv(all_movements_feed(spark, sf_dir), landing_dir, MOVEMENTS.name, export_time(F.col("movement_date")), rebalance=False)
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    layers.load_bronze(lake, MOVEMENTS, landing_dir, FIRST_RUN, grain=grain)
    layers.promote_silver(lake, MOVEMENTS, grain=grain)
    rows = as_doubles(lake.read(layers.silver_table(MOVEMENTS)).drop(PERIOD), "qty_delta")
    return as_plain_time(rows, "movement_ts", "erp_export_ts", "processed_date")


def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds from landing to Gold in one run; daily sales by the name of their view."""
    d = Domain(spark, sf_dir)
    lake, landing_dir = export_sales(spark, sf_dir, "job")
    landing.export_csv(movement_feed(spark, sf_dir), landing_dir, MOVEMENTS.name, export_time(F.col("movement_date")), rebalance=False)
    job.run_batch(lake, landing_dir, FIRST_RUN, grain=grain_for(d, "orders", "o_orderdate"), buckets=buckets_for(d, "lineitem"))
    return as_doubles(lake.read("vw_gold_daily_sales"), "total_qty_sold", "total_revenue_eur")


def broken_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales feed with an unknown status, a code that is too long, and a product nobody knows, by the last digit of the order."""
    feed = Domain(spark, sf_dir).sales_feed()
    last = F.col("order_id").cast("long") % 10
    return feed.withColumns(
        {
            "status": F.when(last == 4, "lost").otherwise(F.col("status")),
            "customer_code": F.when(last == 5, F.concat("customer_code", F.lit("-long"))).otherwise(F.col("customer_code")),
            "product_id": F.when(last == 6, F.concat(F.lit("no-"), "product_id")).otherwise(F.col("product_id")),
        }
    )


def dimensions(d: Domain) -> dict[str, DataFrame]:
    return {"customers": d.customers(), "locations": d.locations(), "products": d.products()}


def where_rows_are(lake: Lake) -> DataFrame:
    """Every key with the place it has come to: Silver, rejected while landing, or in quarantine, with the reasons."""
    why = F.array_join("reasons", ",")
    keys = ["order_id", "product_id"]
    silver = lake.read(layers.silver_table(SALES)).select(*keys, F.lit("silver").alias("place"))
    rejected = lake.read(layers.rejected_table(SALES)).select(*keys, F.concat(F.lit("rejected "), why).alias("place"))
    waiting = lake.read(layers.quarantine_table(SALES)).select(*keys, F.concat(F.lit("quarantine "), why).alias("place"))
    return silver.unionByName(rejected).unionByName(waiting)


def silver_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the feed refuse rows while landing, unknown references keep them out of Silver; every row is in one place."""
    lake, landing_dir = export_sales(spark, sf_dir, "rules", broken_feed(spark, sf_dir))
    d = Domain(spark, sf_dir)
    grain = grain_for(d, "orders", "o_orderdate")
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain)
    layers.promote_silver(lake, SALES, grain=grain, parents=dimensions(d))
    return where_rows_are(lake)


def quarantine_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that become known later: their rows wait, enter Silver when they do, and leave the quarantine; what is still unknown stays."""
    lake, landing_dir = export_sales(spark, sf_dir, "quarantine", broken_feed(spark, sf_dir))
    d = Domain(spark, sf_dir)
    grain, known = grain_for(d, "orders", "o_orderdate"), dimensions(d)
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain)
    few = {**known, "products": known["products"].where("product_id % 7 <> 0")}
    layers.promote_silver(lake, SALES, grain=grain, parents=few)
    before = materialise(where_rows_are(lake).withColumn("moment", F.lit("before")), "before")
    layers.release_quarantine(lake, SALES, known, grain)
    return before.unionByName(where_rows_are(lake).withColumn("moment", F.lit("after")))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold totals kept by changes: after a load, a load of corrections and a backfill of older exports they are what a full build gives."""
    lake, landing_dir = export_sales(spark, sf_dir, "gold")
    grain = grain_for(Domain(spark, sf_dir), "orders", "o_orderdate")
    at = export_time(F.col("order_date")) + F.expr("INTERVAL 1 HOUR")
    for moment, since, until in ((FIRST_RUN, SINCE, None), (SECOND_RUN, SINCE, None), (THIRD_RUN, None, SINCE)):
        if moment == SECOND_RUN:  # the first load has not seen the corrections, which replace rows that Gold has taken in
            landing.export_csv(corrected(spark, sf_dir), landing_dir, SALES.name, at, rebalance=False)
        layers.load_bronze(lake, SALES, landing_dir, moment, since, grain=grain, until=until)
        layers.promote_silver(lake, SALES, grain=grain)
        gold = gold_tables.gold_sales(lake, buckets_for(Domain(spark, sf_dir), "lineitem"))
        gold.refresh()
    return as_doubles(gold.totals(), "total_qty_sold", "total_revenue_eur")


# Merge operators: orders as a table, keyed by order and date.
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("total_eur", T.DecimalType(14, 2)),
    ]
)
ORDER_KEYS = ["order_id", "order_date"]
LINE_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("supplier_id", T.LongType()),
        T.StructField("qty_ordered", T.DecimalType(12, 2)),
    ]
)


def known_orders(d: Domain) -> DataFrame:
    """State before the batch: orders that are not open."""
    return order_rows(d).where(F.col("status") != "O")


def changed_orders(d: Domain) -> DataFrame:
    """The batch: orders in progress with a new total and, for some, an erased priority, and all open orders."""
    rows = order_rows(d).where(F.col("status") != "F")
    return rows.withColumns(
        {
            "total_eur": (F.col("total_eur") + 10).cast("decimal(14,2)"),
            "priority": F.nullif(F.col("priority"), F.lit("5-LOW")),
        }
    )


def order_rows(d: Domain) -> DataFrame:
    return d.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("total_eur"),
    )


def merged_orders(spark: SparkSession, sf_dir: str, label: str, times: int) -> DataFrame:
    d = Domain(spark, sf_dir)
    lake, grain = Lake.scratch(spark, label), grain_for(d, "orders", "o_orderdate")
    for batch in [known_orders(d)] + [changed_orders(d)] * times:
        merge.upsert(lake, "orders", ORDER_SCHEMA, batch, ORDER_KEYS, "order_date", grain=grain)
    return as_doubles(lake.read("orders").drop(PERIOD), "total_eur")


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_orders(spark, sf_dir, "merge", 1)


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_orders(spark, sf_dir, "rerun", 2)


def dated_lines(d: Domain) -> DataFrame:
    dates = d.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    return d.order_lines().join(dates, "order_id").select(*LINE_SCHEMA.fieldNames())


def upsert_empty_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines keyed by order and date only: with nothing to match, every line goes in."""
    d = Domain(spark, sf_dir)
    lake, grain = Lake.scratch(spark, "empty"), grain_for(d, "orders", "o_orderdate")
    merge.upsert(lake, "lines", LINE_SCHEMA, dated_lines(d), ORDER_KEYS, "order_date", "insert", grain=grain)
    return as_doubles(lake.read("lines").drop(PERIOD), "qty_ordered")


def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the target that several lines of a batch keyed by order would match."""
    d = Domain(spark, sf_dir)
    return merge.merge_conflicts(known_orders(d), dated_lines(d), ORDER_KEYS)


_YEARLY = "date_trunc('year', order_date) + INTERVAL 18 HOURS"
_FILE = f"'sales_' || strftime({_YEARLY}, '%Y%m%d_%H%M%S') || '.csv'"
_MOVES = f"""{sql.SALE_LINES}, {sql.LOCATIONS},
moves AS (
    SELECT concat_ws('-', 'sale', order_id, line_no, product_id, supplier_id) AS movement_id, order_ts AS movement_ts,
        order_date AS movement_date, 'sale' AS movement_type, CAST(product_id AS VARCHAR) AS product_id,
        printf('SKU-%05d', product_id) AS sku, CAST(location_id AS VARCHAR) AS location_id, location_code,
        CAST(-SUM(qty_fulfilled) AS DOUBLE) AS qty_delta, CAST(order_id AS VARCHAR) AS ref_order_id,
        'sales_order' AS ref_order_type, 'Sale, "as fulfilled"' || chr(10) || 'by line' AS notes, order_ts + INTERVAL 18 HOURS AS erp_export_ts
    FROM sale_lines JOIN locations USING (location_id) WHERE qty_fulfilled > 0 GROUP BY ALL)"""
_MERGED = """WITH known AS (
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
        o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(14,2)) AS total_eur
    FROM orders WHERE o_orderstatus <> 'O'),
batch AS (
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
        nullif(o_orderpriority, '5-LOW') AS priority, CAST(o_totalprice AS DECIMAL(14,2)) + 10 AS total_eur
    FROM orders WHERE o_orderstatus <> 'F')
SELECT COALESCE(b.order_id, k.order_id) AS order_id, COALESCE(b.order_date, k.order_date) AS order_date,
    CASE WHEN b.order_id IS NOT NULL THEN b.status ELSE k.status END AS status,
    CASE WHEN b.order_id IS NOT NULL THEN b.priority ELSE k.priority END AS priority,
    CAST(CASE WHEN b.order_id IS NOT NULL THEN b.total_eur ELSE k.total_eur END AS DOUBLE) AS total_eur
FROM known k FULL JOIN batch b ON b.order_id = k.order_id AND b.order_date = k.order_date"""

_PLACES = """, places AS (
    SELECT order_id, CASE WHEN d = 6 THEN 'no-' || product_id ELSE product_id END AS product_id, CAST(product_id AS BIGINT) AS own, d,
        CASE d WHEN 4 THEN 'rejected domain:status' WHEN 5 THEN 'rejected length:customer_code' ELSE 'silver' END AS place
    FROM (SELECT *, CAST(order_id AS BIGINT) % 10 AS d FROM sales_feed))
"""

QUERIES = {
    "incremental_landing": (
        incremental_landing,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT order_id, product_id, CAST(order_date AS VARCHAR) AS order_date,
    printf('%.2f', line_total_eur) AS line_total_eur, {_FILE} AS source_file
FROM sales_feed WHERE {_YEARLY} >= TIMESTAMP '{SINCE}'""",
    ),
    "feed_routing": (
        feed_routing,
        sql.with_(_MOVES)
        + f""", named AS (
    SELECT 'sales' AS feed, order_date FROM (SELECT DISTINCT order_id, product_id, order_date FROM sale_lines)
    UNION ALL SELECT 'inventory_movements', movement_date FROM moves)
SELECT feed, feed || '_' || strftime({_YEARLY}, '%Y%m%d_%H%M%S') || '.csv' AS source_file, COUNT(*) AS n_rows
FROM named GROUP BY 1, 2""",
    ),
    "csv_ingest": (csv_ingest, sql.with_(sql.SALES_FEED) + "SELECT * FROM sales_feed"),
    "csv_export_roundtrip": (csv_export_roundtrip, sql.with_(_MOVES) + "SELECT * FROM moves"),
    "raw_partition_roundtrip": (
        raw_partition_roundtrip,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT order_id, product_id, CAST(order_date AS VARCHAR) AS order_date,
    printf('%.2f', qty_ordered) AS qty_ordered, printf('%.2f', line_total_eur) AS line_total_eur,
    {_YEARLY} AS ingestion_date FROM sales_feed""",
    ),
    "latest_partition": (
        latest_partition,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT order_id, product_id, CAST(order_date AS VARCHAR) AS order_date, sku, {_YEARLY} AS ingestion_date
FROM sales_feed WHERE {_YEARLY} = (SELECT MAX({_YEARLY}) FROM sales_feed)""",
    ),
    "bronze_load": (
        bronze_load,
        sql.with_(sql.SALES_FEED)
        + f"SELECT *, 'ERP' AS source_system, TIMESTAMP '{SECOND_RUN}' AS processed_date FROM sales_feed",
    ),
    "silver_promote": (
        silver_promote,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT *, 'ERP' AS source_system, CASE WHEN {_YEARLY} >= TIMESTAMP '{SINCE}'
    THEN TIMESTAMP '{SECOND_RUN}' ELSE TIMESTAMP '{FIRST_RUN}' END AS processed_date
FROM sales_feed""",
    ),
    "load_reconciliation": (
        load_reconciliation,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT source_file, CAST(SUM(landed) AS BIGINT) AS landed, CAST(SUM(accepted) AS BIGINT) AS accepted,
    CAST(SUM(rejected) AS BIGINT) AS rejected, CAST(SUM(superseded) AS BIGINT) AS superseded
FROM (
    SELECT {_FILE} AS source_file, CASE WHEN d = 0 THEN 2 ELSE 1 END AS landed, CASE WHEN d > 3 THEN 1 ELSE 0 END AS accepted,
        CASE WHEN d = 0 THEN 2 WHEN d < 3 THEN 1 ELSE 0 END AS rejected, CASE WHEN d = 3 THEN 1 ELSE 0 END AS superseded
    FROM (SELECT *, CAST(order_id AS BIGINT) % 10 AS d FROM sales_feed)
    UNION ALL
    SELECT replace({_FILE}, '_180000', '_190000'), 1, 1, 0, 0 FROM sales_feed WHERE CAST(order_id AS BIGINT) % 10 = 3)
GROUP BY 1""",
    ),
    "incompatible_exports": (
        incompatible_exports,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT source_file, COUNT(*) AS landed, CAST(SUM(ok) AS BIGINT) AS accepted, CAST(SUM(1 - ok) AS BIGINT) AS rejected,
    CAST(0 AS BIGINT) AS superseded
FROM (SELECT {_FILE} AS source_file, 1 AS ok FROM sales_feed UNION ALL SELECT replace({_FILE}, '_180000', '_190000'), 0 FROM sales_feed)
GROUP BY 1""",
    ),
    "schema_drift": (
        schema_drift,
        sql.with_(sql.SALES_FEED)
        + f"""SELECT order_id || '-' || product_id AS line, qty_ordered, CASE d WHEN 1 THEN 'via, ' || source END AS channel, '' AS reason, 1 AS n
FROM (SELECT *, CAST(order_id AS BIGINT) % 4 AS d FROM sales_feed) WHERE d < 3
UNION ALL
SELECT {_FILE}, NULL, NULL, 'schema:missing line_total_eur', COUNT(*) FROM sales_feed WHERE CAST(order_id AS BIGINT) % 4 = 3 GROUP BY 1""",
    ),
    "silver_unfit_values": (
        silver_unfit_values,
        sql.with_(sql.SALES_FEED)
        + """SELECT order_id, product_id, CASE d WHEN 0 THEN 'duplicate_key' WHEN 1 THEN 'type:order_total_eur'
    WHEN 2 THEN 'type:order_total_eur' ELSE '' END AS reason
FROM (SELECT *, CAST(order_id AS BIGINT) % 10 AS d FROM sales_feed), range(2) t(k) WHERE k = 0 OR d = 0""",
    ),
    "silver_backfill": (
        silver_backfill,
        sql.with_(sql.SALES_FEED) + "SELECT order_id, product_id, order_date, line_total_eur FROM sales_feed",
    ),
    "silver_movements": (
        silver_movements,
        sql.with_(sql.SALE_LINES, sql.INVENTORY, sql.PURCHASE_LINES, sql.LEDGER, sql.LOCATIONS)
        + f""", moves AS (
    SELECT * FROM ledger
    UNION ALL
    SELECT concat_ws('-', kind, product_id, location_id), product_id, location_id, kind, qty, NULL, kind, moved_at, notes
    FROM inventory JOIN (VALUES (0, 'adjustment', -1, TIMESTAMP '1998-06-30 12:00:00', 'Cycle count correction'),
        (5, 'transfer', 5, TIMESTAMP '1998-09-30 12:00:00', 'Transfer to the next location')) AS v(place, kind, qty, moved_at, notes)
        ON (product_id + location_id) % 10 = place)
SELECT movement_id, movement_ts, CAST(movement_ts AS DATE) AS movement_date, movement_type, CAST(product_id AS VARCHAR) AS product_id,
    printf('SKU-%05d', product_id) AS sku, CAST(location_id AS VARCHAR) AS location_id, location_code, CAST(SUM(qty_delta) AS DOUBLE) AS qty_delta,
    CAST(ref_order_id AS VARCHAR) AS ref_order_id, ref_order_type, notes, movement_ts + INTERVAL 18 HOURS AS erp_export_ts,
    'ERP' AS source_system, TIMESTAMP '{FIRST_RUN}' AS processed_date
FROM moves JOIN locations USING (location_id) GROUP BY ALL""",
    ),
    "batch_job": (
        batch_job,
        sql.with_(sql.SALES_FEED)
        + """SELECT order_date, location_code, product_id, sku,
    CAST(SUM(CAST(qty_fulfilled AS DECIMAL(12,2))) AS DOUBLE) AS total_qty_sold,
    CAST(SUM(CAST(line_total_eur AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue_eur, COUNT(*) AS n_lines
FROM sales_feed GROUP BY 1, 2, 3, 4""",
    ),
    "silver_rules": (
        silver_rules,
        sql.with_(sql.SALES_FEED) + _PLACES + "SELECT order_id, product_id, CASE WHEN d = 6 THEN 'quarantine unknown:product_id' ELSE place END AS place FROM places",
    ),
    "quarantine_release": (
        quarantine_release,
        sql.with_(sql.SALES_FEED)
        + _PLACES
        + """SELECT order_id, product_id, moment, CASE WHEN d = 6 OR (place = 'silver' AND own % 7 = 0 AND moment = 'before') THEN 'quarantine unknown:product_id' ELSE place END AS place
FROM places, (VALUES ('before'), ('after')) AS v(moment)""",
    ),
    "gold_incremental": (
        gold_incremental,
        sql.with_(sql.SALES_FEED)
        + """SELECT product_id, location_code, CAST(SUM(CAST(qty_fulfilled AS DECIMAL(12,2))) AS DOUBLE) AS total_qty_sold,
    CAST(SUM(CAST(line_total_eur AS DECIMAL(12,2)) + CASE WHEN CAST(order_id AS BIGINT) % 10 = 3 THEN 2 ELSE 0 END) AS DOUBLE) AS total_revenue_eur,
    COUNT(*) AS n_rows
FROM sales_feed GROUP BY 1, 2""",
    ),
    "upsert_merge": (upsert_merge, _MERGED),
    "upsert_idempotent": (upsert_idempotent, _MERGED),
    "upsert_empty_target": (
        upsert_empty_target,
        sql.with_(sql.ORDER_LINES)
        + """SELECT order_id, CAST(o_orderdate AS DATE) AS order_date, line_no, product_id, supplier_id,
    CAST(qty_ordered AS DOUBLE) AS qty_ordered
FROM order_lines JOIN orders ON o_orderkey = order_id""",
    ),
    "merge_conflicts": (
        merge_conflicts,
        """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS n_rows
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O'
GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    ),
}
