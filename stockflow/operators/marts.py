"""Views over the operational model. They are unordered; sort where the rows are shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.expressions import (
    exact_rate,
    lead_days,
    line_total,
    ratio,
    receipt_time,
    stock_status,
)
from stockflow.lake import Lake

LEDGER_COLUMNS = [
    "movement_id",
    "product_id",
    "location_id",
    "movement_type",
    "qty_delta",
    "ref_order_id",
    "ref_order_type",
    "movement_ts",
    "notes",
]


def inventory_status(inventory: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    """Stock per product and location with its status bucket."""
    return (
        inventory.join(products.select("product_id", "sku", "product_name", "category"), "product_id")
        .join(locations.select("location_id", "location_name", "location_type", "region"), "location_id")
        .select(
            "location_name",
            "location_type",
            "region",
            "sku",
            "product_name",
            "category",
            "qty_on_hand",
            "qty_reserved",
            (F.col("qty_on_hand") - F.col("qty_reserved")).alias("qty_available"),
            "min_stock_level",
            "reorder_point",
            "max_stock_level",
            stock_status(F.col("qty_on_hand"), F.col("min_stock_level"), F.col("reorder_point")).alias("stock_status"),
        )
    )


def daily_sales(sale_lines: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    """Quantity and revenue per day, location, category and product name."""
    return (
        sale_lines.select("order_date", "location_id", "product_id", "qty_fulfilled", "line_total_eur")
        .join(products.select("product_id", "category", "product_name"), "product_id")
        .join(locations.select("location_id", "location_name"), "location_id")
        .groupBy(F.col("order_date").alias("sale_date"), "location_name", "category", "product_name")
        .agg(
            F.sum("qty_fulfilled").alias("total_qty_sold"),
            F.sum("line_total_eur").alias("total_revenue_eur"),
        )
    )


def ordered_sales(daily: DataFrame) -> DataFrame:
    """Newest day first, and largest quantity first within a day; names decide ties."""
    return daily.orderBy(F.desc("sale_date"), F.desc("total_qty_sold"), "location_name", "category", "product_name")


def top_sales(daily: DataFrame, n: int) -> DataFrame:
    return ordered_sales(daily).limit(n)


def supplier_performance(purchase_orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Delivered orders, mean lead time and on-time rate per supplier; an unknown due date counts as late.

    The orders are aggregated by supplier before the join: suppliers without a delivery drop out either way.
    """
    on_time = F.when(F.col("actual_delivery") <= F.col("expected_delivery"), 1).otherwise(0)
    per_supplier = (
        purchase_orders.where(F.col("actual_delivery").isNotNull())
        .groupBy("supplier_id")
        .agg(
            F.count(F.lit(1)).alias("total_pos"),
            F.sum(lead_days(F.col("created_on"), F.col("actual_delivery"))).alias("lead_days"),
            F.sum(on_time).alias("on_time"),
        )
    )
    return per_supplier.join(suppliers, "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "country",
        "total_pos",
        ratio(F.col("lead_days"), F.col("total_pos")).alias("avg_actual_lead_days"),
        F.col("avg_lead_time_days").alias("contracted_lead_days"),
        exact_rate(F.col("on_time"), F.col("total_pos")).alias("on_time_rate"),
    )


def lookup_with_default(
    df: DataFrame, dimension: DataFrame, key: str, columns: dict[str, object]
) -> DataFrame:
    """Left lookup by key; ``columns`` maps the dimension's columns to the value used when nothing matches.

    A match keeps its values, also NULLs. Of several dimension rows with one key the smallest counts, so no row of ``df`` is multiplied.
    """
    found = dimension.groupBy(key).agg(F.min(F.struct(*columns)).alias("_found"))
    values = {c: F.when(F.col("_found").isNotNull(), F.col(f"_found.{c}")).otherwise(F.lit(default)) for c, default in columns.items()}
    return df.join(found, key, "left").withColumns(values).drop("_found")


def priced_lines(values: DataFrame, orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines derived from an inline relation ``(source, qty)``: each line of an order of that source gets the
    relation's quantity at the product's list price."""
    return (
        lines.select("order_id", "line_no", "product_id", "supplier_id")
        .join(orders.select("order_id", "source").join(F.broadcast(values), "source"), "order_id")
        .join(products.select("product_id", "unit_price_eur"), "product_id")
        .select(
            "order_id",
            "line_no",
            "product_id",
            "supplier_id",
            F.col("qty").alias("qty_ordered"),
            F.col("qty").alias("qty_fulfilled"),
            "unit_price_eur",
            line_total(F.col("qty"), F.col("unit_price_eur")).alias("line_total_eur"),
        )
    )


def inline_values(spark, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A relation from literals in the program; its size is that of the program text."""
    return spark.createDataFrame(rows, schema)


def movement_ledger(inventory: DataFrame, lines: DataFrame, opened_at: str) -> DataFrame:
    """All stock movements: opening stock, sales (out) and purchase receipts (in).

    ``lines`` are order lines with their order and both locations (``Domain.traded_lines``): each gives its sale and its receipt in one pass.
    """
    nothing = F.lit(None).cast("bigint")
    opening = inventory.select(
        F.concat_ws("-", F.lit("open"), "product_id", "location_id").alias("movement_id"),
        "product_id",
        "location_id",
        F.lit("initial_stock").alias("movement_type"),
        F.col("qty_on_hand").alias("qty_delta"),
        nothing.alias("ref_order_id"),
        F.lit(None).cast("string").alias("ref_order_type"),
        F.lit(opened_at).cast("timestamp_ntz").alias("movement_ts"),
        F.lit("Opening stock balance").alias("notes"),
    )
    kinds = F.array(
        F.when(F.col("location_id").isNotNull(), "sale"),
        F.when(F.col("supplier_location_id").isNotNull() & F.col("actual_delivery").isNotNull(), "receipt"),
    )
    # The columns are made of the exploded kind, so those that a reader does not take are never made.
    moved = lines.where(F.col("qty_fulfilled") > 0).withColumn("_kind", F.explode(F.array_compact(kinds)))
    return opening.unionByName(moved.select(*movement(F.col("_kind") == "sale")))


def store_derived(lake: Lake, table: str, movements: DataFrame) -> None:
    """Write derived movements to a table by their type: a load that is done again replaces what it wrote, and leaves other types alone.

    There are few types, so each task writes what it has of them and no row is shuffled for it.
    """
    lake.ensure(table, movements.select(*LEDGER_COLUMNS).schema, "movement_type")
    lake.replace_partitions(table, movements, "movement_type", rebalance=False)


def movement(sold: Column) -> list[Column]:
    """One ledger row of an order line: its sale where ``sold``, else its receipt."""
    order, supplier = F.col("order_id").cast("string"), F.col("supplier_id").cast("string")

    def either(sale: object, receipt: object) -> Column:
        return F.when(sold, sale).otherwise(receipt)

    return [
        F.concat_ws("-", either("sale", "receipt"), "order_id", "line_no", "product_id", "supplier_id").alias("movement_id"),
        F.col("product_id"),
        either(F.col("location_id"), F.col("supplier_location_id")).alias("location_id"),
        either("sale", "po_receipt").alias("movement_type"),
        either(-F.col("qty_fulfilled"), F.col("qty_fulfilled")).cast("decimal(13,2)").alias("qty_delta"),
        F.col("order_id").alias("ref_order_id"),
        either("sales_order", "purchase_order").alias("ref_order_type"),
        either(F.col("order_ts").cast("timestamp_ntz"), receipt_time(F.col("actual_delivery")).cast("timestamp_ntz")).alias("movement_ts"),
        either(F.concat(F.lit("Fulfilled from sales order "), order), F.concat(F.lit("Received from PO "), order, F.lit(" — supplier "), supplier)).alias("notes"),
    ]


def preview(df: DataFrame, columns: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order. A sort with a limit keeps only ``n`` rows per task."""
    return df.select(*columns).orderBy(*order).limit(n)
