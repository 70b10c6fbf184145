"""Projections, joins, aggregates and windows over the operational model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.expressions import fulfilment_status, lead_days, line_total, on_day
from stockflow.lake import materialise
from stockflow.operators import marts, merge, running
from stockflow.plans import gold
from stockflow.plans.layers import add_load_columns
from stockflow.queries import sql
from stockflow.queries.common import as_doubles, as_plain_time
from stockflow.sources import oltp
from stockflow.sources.domain import OPENING_TIME, Domain

TOP_N = 100
PREVIEW_COLUMNS = ["order_id", "order_date", "source", "location_id"]
# Quantity per order source, as literals of the program.
SOURCE_QTY = [("counter", 1.0), ("phone", 2.0), ("online", 3.5), ("erp_import", 10.25)]


def bronze_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Domain(spark, sf_dir).table("orders")
    return as_plain_time(add_load_columns(orders, "2025-01-06 18:05:00", "ERP"), "processed_date")


def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.preview(Domain(spark, sf_dir).orders(), PREVIEW_COLUMNS, ["order_id"])


def silver_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Domain(spark, sf_dir).table("events")
    return events.where(on_day(F.col("ts"), F.lit("2024-01-15"))).select("event_id", "ts", "event_type", "value")


def active_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = oltp.active_only(Domain(spark, sf_dir).customers())
    return customers.select("customer_id", "customer_code", "customer_name", "customer_type")


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Domain(spark, sf_dir).table("lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    total = line_total(F.col("l_quantity").cast("decimal(6,2)"), price)
    shown = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", total.alias("line_total"))
    return as_doubles(shown, "line_total")


def fulfilment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Domain(spark, sf_dir).order_lines()
    status = fulfilment_status(F.col("qty_fulfilled"), F.col("qty_ordered"))
    shown = lines.select("order_id", "line_no", "product_id", "supplier_id", "qty_ordered", "qty_fulfilled", status.alias("status"))
    return as_doubles(shown, "qty_ordered", "qty_fulfilled")


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Domain(spark, sf_dir).table("orders")
    at, name = F.col("o_orderdate"), F.concat(F.lit("sales_"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss"), F.lit(".csv"))
    stamp = F.regexp_extract("file_name", r"_(\d{8}_\d{6})\.csv$", 1)
    return orders.withColumn("file_name", name).select(
        "o_orderkey",
        F.to_date(at).alias("day"),
        (at + F.expr("INTERVAL 8 HOURS")).alias("morning"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        lead_days(F.lit("1995-01-01"), at).alias("days_since"),
        F.round(F.col("o_totalprice").cast("decimal(12,2)"), 1).cast("double").alias("rounded"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("label"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("state"),
        F.split("o_orderpriority", "-").getItem(1).alias("priority"),
        F.endswith("file_name", F.lit(".csv")).alias("is_csv"),
        F.startswith("file_name", F.lit("sales")).alias("is_sales"),
        F.to_timestamp(stamp, "yyyyMMdd_HHmmss").cast("timestamp_ntz").alias("file_time"),
        F.url_decode(F.lit("2026-01-05 18%3A05%3A00")).alias("decoded"),
        F.to_timestamp(F.lit("2025-01-06 18:05:00")).cast("timestamp_ntz").alias("literal_time"),
    )


def inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    status = marts.inventory_status(d.inventory(), d.products(), d.locations())
    numbers = ["qty_on_hand", "qty_reserved", "qty_available", "min_stock_level", "reorder_point", "max_stock_level"]
    return as_doubles(status, *numbers).orderBy("location_name", "category", "product_name", "sku")


def daily_sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return marts.daily_sales(d.sale_lines(), d.products(), d.locations())


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(daily_sales_table(spark, sf_dir), "total_qty_sold", "total_revenue_eur")


def top_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(marts.top_sales(daily_sales_table(spark, sf_dir), TOP_N), "total_qty_sold", "total_revenue_eur")


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(marts.ordered_sales(daily_sales_table(spark, sf_dir)), "total_qty_sold", "total_revenue_eur")


def supplier_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    rated = marts.supplier_performance(d.purchase_lines(), d.suppliers())
    return as_doubles(rated, "on_time_rate").orderBy(F.desc_nulls_first("on_time_rate"), "supplier_id")


def available_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    shown = oltp.available_stock(d.inventory(), d.locations()).select(
        "product_id", "location_id", "location_name", "qty_on_hand", "qty_reserved"
    )
    return as_doubles(shown, "qty_on_hand", "qty_reserved")


def open_po_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    orders = d.table("orders").select(
        F.col("o_orderkey").alias("po_id"),
        F.when(F.col("o_orderstatus") == "O", "sent").when(F.col("o_orderstatus") == "P", "confirmed").otherwise("received").alias("status"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("expected_delivery"),
    )
    lines = d.order_lines().withColumnsRenamed({"order_id": "po_id", "qty_fulfilled": "qty_received"})
    shown = oltp.open_purchase_lines(orders, lines).select(
        "po_id", "line_no", "supplier_id", "product_id", "status", "qty_ordered", "qty_received", "expected_delivery"
    )
    return as_doubles(shown, "qty_ordered", "qty_received")


def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    active = oltp.active_only(d.customers())
    orders = d.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    return marts.lookup_with_default(orders, active, "customer_id", {"customer_name": "unknown", "customer_type": "individual"})


def values_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    values = marts.inline_values(spark, SOURCE_QTY, "source string, qty double")
    values = values.withColumn("qty", F.col("qty").cast("decimal(10,2)"))
    made = marts.priced_lines(values, d.order_sources(), d.order_lines(), d.products())
    return as_doubles(made, "qty_ordered", "qty_fulfilled", "unit_price_eur", "line_total_eur")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return marts.movement_ledger(d.inventory(), d.traded_lines(), OPENING_TIME)


def movement_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(ledger(spark, sf_dir), "qty_delta")


def stock_on_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(gold.stock_on_hand(ledger(spark, sf_dir)), "qty_on_hand", "qty_transferred")


def stock_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is written once: looking for hot keys and adding up would otherwise repeat its joins."""
    moves = ledger(spark, sf_dir).select("product_id", "location_id", "movement_ts", "movement_id", "qty_delta")
    moves = materialise(moves, "ledger")
    balance = running.running_sum(moves, ["product_id", "location_id"], ["movement_ts", "movement_id", "qty_delta"], "qty_delta", "balance")
    return as_doubles(balance, "qty_delta", "balance")


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Domain(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    return merge.latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


LINE_ORDER = ["line_no", "product_id", "supplier_id"]


def order_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Domain(spark, sf_dir).order_lines().select("order_id", *LINE_ORDER, "line_total_eur")
    totals = running.running_sum(lines, ["order_id"], LINE_ORDER, "line_total_eur", "order_total_eur")
    return as_doubles(totals, "line_total_eur", "order_total_eur")


def order_true_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Domain(spark, sf_dir).order_lines().select("order_id", *LINE_ORDER, "line_total_eur")
    totals = running.group_total(lines, ["order_id"], "line_total_eur", "order_total_eur")
    return as_doubles(totals, "line_total_eur", "order_total_eur")


SERIES = ["category", "region"]


def dense_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand per product category and region. Products and locations are mapped before the calendar opens."""
    d = Domain(spark, sf_dir)
    sold = d.sale_lines().select("product_id", "location_id", "order_date", "qty_ordered")
    placed = sold.join(d.locations().select("location_id", "region"), "location_id")
    named = placed.join(d.products().select("product_id", "category"), "product_id")
    return gold.demand_daily_dense(named, SERIES)


def demand_daily_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(dense_demand(spark, sf_dir), "demand_qty")


def forecast_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(gold.forecast_moving_average(dense_demand(spark, sf_dir), SERIES), "demand_qty")


def forecast_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.forecast_weekday(dense_demand(spark, sf_dir), SERIES)


def reorder_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    demand = d.sale_lines().groupBy("product_id", "location_id").agg(F.sum("qty_ordered").alias("total_qty"))
    n_days = d.table("orders").agg(F.datediff(F.max("o_orderdate"), F.min("o_orderdate")) + 1).first()[0]
    plan = gold.reorder_plan(demand, d.inventory(), d.products(), n_days)
    return as_doubles(plan, "qty_available", "qty_to_order")


def kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return as_doubles(gold.kpi_daily(d.traded_lines()), "revenue_eur")


_DAILY = (
    sql.with_(sql.SALE_LINES, sql.PRODUCTS, sql.LOCATIONS)
    + """SELECT order_date AS sale_date, location_name, category, product_name,
    CAST(SUM(qty_fulfilled) AS DOUBLE) AS total_qty_sold, CAST(SUM(line_total_eur) AS DOUBLE) AS total_revenue_eur
FROM sale_lines JOIN products USING (product_id) JOIN locations USING (location_id)
GROUP BY 1, 2, 3, 4"""
)
_LEDGER = sql.with_(sql.SALE_LINES, sql.INVENTORY, sql.PURCHASE_LINES, sql.LEDGER)
_DENSE_CTE = (
    sql.SALE_LINES
    + ", "
    + sql.PRODUCTS.strip()
    + ", "
    + sql.LOCATIONS.strip()
    + """,
daily AS (
    SELECT category, region, order_date AS demand_date, SUM(qty_ordered) AS qty
    FROM sale_lines JOIN products USING (product_id) JOIN locations USING (location_id)
    GROUP BY 1, 2, 3),
spine AS (
    SELECT category, region, CAST(unnest(generate_series(MIN(demand_date), MAX(demand_date), INTERVAL 1 DAY)) AS DATE)
        AS demand_date
    FROM daily GROUP BY 1, 2),
dense AS (
    SELECT category, region, demand_date, COALESCE(qty, 0) AS demand_qty
    FROM spine LEFT JOIN daily USING (category, region, demand_date))"""
)

QUERIES = {
    "bronze_enrich": (
        bronze_enrich,
        "SELECT *, TIMESTAMP '2025-01-06 18:05:00' AS processed_date, 'ERP' AS source_system FROM orders",
    ),
    "bronze_preview": (
        bronze_preview,
        sql.with_(sql.ORDERS)
        + "SELECT order_id, order_date, source, location_id FROM located_orders ORDER BY order_id LIMIT 5",
    ),
    "silver_day_filter": (
        silver_day_filter,
        "SELECT event_id, ts, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    ),
    "active_dimension": (
        active_dimension,
        sql.with_(sql.CUSTOMERS)
        + "SELECT customer_id, customer_code, customer_name, customer_type FROM customers WHERE is_active",
    ),
    "line_total": (
        line_totals,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(round(CAST(l_quantity AS DECIMAL(6,2)) * (CAST(l_extendedprice AS DECIMAL(12,2))
        * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS line_total
FROM lineitem""",
    ),
    "fulfilment_status": (
        fulfilment,
        sql.with_(sql.ORDER_LINES)
        + """SELECT order_id, line_no, product_id, supplier_id, CAST(qty_ordered AS DOUBLE) AS qty_ordered,
    CAST(qty_fulfilled AS DOUBLE) AS qty_fulfilled,
    CASE WHEN qty_fulfilled >= qty_ordered THEN 'fulfilled' ELSE 'partial' END AS status
FROM order_lines""",
    ),
    "scalar_functions": (
        scalar_functions,
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderdate + INTERVAL 8 HOURS AS morning,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
    CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days_since,
    CAST(round(CAST(o_totalprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS rounded, 'order ' || o_orderkey AS label,
    CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
    split_part(o_orderpriority, '-', 2) AS priority,
    suffix('sales_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '.csv', '.csv') AS is_csv,
    starts_with('sales_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '.csv', 'sales') AS is_sales,
    o_orderdate AS file_time, '2026-01-05 18:05:00' AS decoded, TIMESTAMP '2025-01-06 18:05:00' AS literal_time
FROM orders""",
    ),
    "inventory_status": (
        inventory_status,
        sql.with_(sql.INVENTORY, sql.PRODUCTS, sql.LOCATIONS)
        + """SELECT location_name, location_type, region, sku, product_name, category,
    CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, CAST(qty_reserved AS DOUBLE) AS qty_reserved,
    CAST(qty_on_hand - qty_reserved AS DOUBLE) AS qty_available, CAST(min_stock_level AS DOUBLE) AS min_stock_level,
    CAST(reorder_point AS DOUBLE) AS reorder_point, CAST(max_stock_level AS DOUBLE) AS max_stock_level,
    CASE WHEN qty_on_hand = 0 THEN 'RUPTURED' WHEN qty_on_hand <= min_stock_level THEN 'BELOW_MIN'
        WHEN qty_on_hand <= reorder_point THEN 'REORDER' ELSE 'OK' END AS stock_status
FROM inventory JOIN products USING (product_id) JOIN locations USING (location_id)
ORDER BY location_name, category, product_name, sku""",
    ),
    "daily_sales": (daily_sales, _DAILY),
    "top_sales": (
        top_sales,
        f"SELECT * FROM ({_DAILY}) ORDER BY sale_date DESC, total_qty_sold DESC, location_name, category, "
        f"product_name LIMIT {TOP_N}",
    ),
    "sales_view": (
        sales_view,
        f"SELECT * FROM ({_DAILY}) ORDER BY sale_date DESC, total_qty_sold DESC, location_name, category, product_name",
    ),
    "supplier_performance": (
        supplier_performance,
        sql.with_(sql.ORDER_LINES, sql.PURCHASE_LINES, sql.SUPPLIERS)
        + """, rated AS (
    SELECT supplier_id, COUNT(*) AS n, SUM(datediff('day', created_on, actual_delivery)) AS days,
        COUNT(*) FILTER (WHERE actual_delivery <= expected_delivery) AS hits
    FROM purchase_lines WHERE actual_delivery IS NOT NULL GROUP BY 1)
SELECT supplier_id, supplier_name, country, n AS total_pos, CAST(days AS DOUBLE) / n AS avg_actual_lead_days,
    CAST(30 AS DOUBLE) AS contracted_lead_days, CAST((200 * hits + n) // (2 * n) AS DOUBLE) / 100 AS on_time_rate
FROM rated JOIN suppliers USING (supplier_id)""",
    ),
    "available_stock": (
        available_stock,
        sql.with_(sql.INVENTORY, sql.LOCATIONS)
        + """SELECT product_id, location_id, location_name, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand,
    CAST(qty_reserved AS DOUBLE) AS qty_reserved
FROM inventory JOIN locations USING (location_id)
WHERE location_type = 'sanicenter' AND qty_on_hand > 0 AND qty_on_hand > qty_reserved""",
    ),
    "open_po_lines": (
        open_po_lines,
        sql.with_(sql.ORDER_LINES, sql.PURCHASE_LINES)
        + """SELECT po_id, line_no, supplier_id, product_id, status, CAST(qty_ordered AS DOUBLE) AS qty_ordered,
    CAST(qty_received AS DOUBLE) AS qty_received, expected_delivery
FROM purchase_lines WHERE status IN ('sent', 'confirmed') AND qty_received < qty_ordered""",
    ),
    "lookup_default": (
        lookup_default,
        sql.with_(sql.CUSTOMERS)
        + """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CASE WHEN customer_id IS NULL THEN 'unknown' ELSE customer_name END AS customer_name,
    CASE WHEN customer_id IS NULL THEN 'individual' ELSE customer_type END AS customer_type
FROM orders LEFT JOIN (SELECT * FROM customers WHERE is_active) ON customer_id = o_custkey""",
    ),
    "values_join": (
        values_join,
        sql.with_(sql.SALE_LINES, sql.PRODUCTS)
        + """SELECT order_id, line_no, product_id, supplier_id, CAST(qty AS DOUBLE) AS qty_ordered,
    CAST(qty AS DOUBLE) AS qty_fulfilled, CAST(unit_price_eur AS DOUBLE) AS unit_price_eur,
    CAST(round(qty * unit_price_eur, 2) AS DOUBLE) AS line_total_eur
FROM (VALUES ('counter', CAST(1.00 AS DECIMAL(10,2))), ('phone', 2.00), ('online', 3.50), ('erp_import', 10.25))
    AS v(source, qty)
JOIN sale_lines USING (source) JOIN products USING (product_id)""",
    ),
    "movement_ledger": (
        movement_ledger,
        _LEDGER
        + """SELECT movement_id, product_id, location_id, movement_type, CAST(qty_delta AS DOUBLE) AS qty_delta, ref_order_id,
    ref_order_type, movement_ts, notes FROM ledger""",
    ),
    "stock_on_hand": (
        stock_on_hand,
        _LEDGER
        + """SELECT product_id, location_id, CAST(SUM(qty_delta) AS DOUBLE) AS qty_on_hand,
    CAST(0 AS DOUBLE) AS qty_transferred, COUNT(*) AS n_movements
FROM ledger GROUP BY 1, 2""",
    ),
    "stock_running_balance": (
        stock_running_balance,
        _LEDGER
        + """SELECT product_id, location_id, movement_ts, movement_id, CAST(qty_delta AS DOUBLE) AS qty_delta,
    CAST(SUM(qty_delta) OVER (PARTITION BY product_id, location_id ORDER BY movement_ts, movement_id, qty_delta
        ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
FROM ledger""",
    ),
    "dedup_latest": (
        dedup_latest,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    ),
    "order_running_total": (
        order_running_total,
        sql.with_(sql.ORDER_LINES)
        + """SELECT order_id, line_no, product_id, supplier_id, CAST(line_total_eur AS DOUBLE) AS line_total_eur,
    CAST(SUM(line_total_eur) OVER (PARTITION BY order_id ORDER BY line_no, product_id, supplier_id
        ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS order_total_eur
FROM order_lines""",
    ),
    "order_true_total": (
        order_true_total,
        sql.with_(sql.ORDER_LINES)
        + """SELECT order_id, line_no, product_id, supplier_id, CAST(line_total_eur AS DOUBLE) AS line_total_eur,
    CAST(SUM(line_total_eur) OVER (PARTITION BY order_id) AS DOUBLE) AS order_total_eur
FROM order_lines""",
    ),
    "demand_daily_dense": (
        demand_daily_dense,
        sql.with_(_DENSE_CTE)
        + "SELECT category, region, demand_date, CAST(demand_qty AS DOUBLE) AS demand_qty FROM dense",
    ),
    "forecast_moving_avg": (
        forecast_moving_avg,
        sql.with_(_DENSE_CTE)
        + """SELECT category, region, demand_date, CAST(demand_qty AS DOUBLE) AS demand_qty,
    CAST(SUM(demand_qty) OVER past AS DOUBLE) / COUNT(*) OVER past AS forecast_qty
FROM dense
WINDOW past AS (PARTITION BY category, region ORDER BY demand_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    ),
    "forecast_weekday": (
        forecast_weekday,
        sql.with_(_DENSE_CTE)
        + """SELECT category, region, dayofweek(demand_date) + 1 AS weekday, COUNT(*) AS n_days,
    CAST(SUM(demand_qty) AS DOUBLE) / COUNT(*) AS forecast_qty
FROM dense GROUP BY 1, 2, 3""",
    ),
    "reorder_point": (
        reorder_point,
        sql.with_(sql.SALE_LINES, sql.INVENTORY, sql.PRODUCTS)
        + """, demand AS (
    SELECT product_id, location_id, CAST(SUM(qty_ordered) AS DOUBLE)
        / (SELECT datediff('day', MIN(o_orderdate), MAX(o_orderdate)) + 1 FROM orders) AS mean
    FROM sale_lines GROUP BY 1, 2),
planned AS (
    SELECT i.product_id, i.location_id, COALESCE(mean, 0) AS avg_daily_demand,
        COALESCE(mean, 0) * lead_time_days + CAST(min_stock_level AS DOUBLE) AS reorder_at, qty_on_hand,
        qty_on_hand - qty_reserved AS available, max_stock_level
    FROM inventory i JOIN products USING (product_id) LEFT JOIN demand USING (product_id, location_id))
SELECT product_id, location_id, avg_daily_demand, reorder_at AS reorder_point, CAST(available AS DOUBLE) AS qty_available,
    CASE WHEN CAST(qty_on_hand AS DOUBLE) <= reorder_at
        THEN CAST(greatest(max_stock_level - available, 0) AS DOUBLE) ELSE 0 END AS qty_to_order
FROM planned""",
    ),
    "kpi_daily": (
        kpi_daily,
        sql.with_(sql.SALE_LINES, sql.PURCHASE_LINES)
        + """, sold AS (
    SELECT order_date AS kpi_date, SUM(line_total_eur) AS revenue, SUM(qty_ordered) AS ordered,
        SUM(qty_fulfilled) AS fulfilled, COUNT(*) AS n_lines
    FROM sale_lines GROUP BY 1),
delivered AS (
    SELECT actual_delivery AS kpi_date, COUNT(*) AS n_deliveries,
        COUNT(*) FILTER (WHERE actual_delivery <= expected_delivery) AS on_time
    FROM purchase_lines WHERE actual_delivery IS NOT NULL GROUP BY 1)
SELECT kpi_date, CAST(revenue AS DOUBLE) AS revenue_eur, n_lines,
    CAST(fulfilled AS DOUBLE) / CAST(ordered AS DOUBLE) AS fill_rate, n_deliveries,
    CAST(on_time AS DOUBLE) / n_deliveries AS on_time_rate
FROM sold FULL JOIN delivered USING (kpi_date)""",
    ),
}
