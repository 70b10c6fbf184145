"""Planning queries over the domain's demand and stock, and the views by their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.lake import Lake
from stockflow.operators import marts
from stockflow.plans import gold, planning, views
from stockflow.queries import marts as mart_queries
from stockflow.queries import sql
from stockflow.queries.common import as_doubles
from stockflow.sources.domain import OPENING_TIME, Domain

SERIES = ["category", "region"]
PLACES = ["product_id", "location_id"]
HORIZON, ALPHA, GAMMA = 28, 0.2, 0.1
LEAD_DAYS, SERVICE, SKETCH_K = 14, 0.95, 4096
AS_OF = "2002-01-01"
TRAILING = 28


def series_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    sold = d.sale_lines().select("product_id", "location_id", "order_date", "qty_ordered")
    placed = sold.join(d.locations().select("location_id", "region"), "location_id")
    return gold.demand_daily(placed.join(d.products().select("product_id", "category"), "product_id"), SERIES)


def place_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.demand_daily(Domain(spark, sf_dir).sale_lines(), PLACES)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    return marts.movement_ledger(d.inventory(), d.traded_lines(), OPENING_TIME)


def forecast_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = planning.forecast_smoothed(series_demand(spark, sf_dir), SERIES, HORIZON, ALPHA, GAMMA)
    return found.withColumn("forecast_qty", F.round("forecast_qty", 4))


def stock_age_fifo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lot with what is left of it; the sum of a place is its stock on hand."""
    return as_doubles(planning.fifo_lots(ledger(spark, sf_dir)), "qty_received", "qty_issued", "qty_left")


def stock_age_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    aged = planning.stock_age(planning.fifo_lots(ledger(spark, sf_dir)), Domain(spark, sf_dir).products(), AS_OF)
    return as_doubles(aged, "qty_on_hand", "value_eur")


def safety_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    sketches = planning.demand_sketches(series_demand(spark, sf_dir), SERIES, LEAD_DAYS, SKETCH_K)
    return planning.safety_stock(sketches, SERIES, SERVICE)


def demand_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(planning.demand_runs(place_demand(spark, sf_dir), PLACES), "demand_qty")


def demand_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(planning.trailing_mean(place_demand(spark, sf_dir), PLACES, TRAILING), "demand_qty")


def operational_lake(spark: SparkSession, sf_dir: str, label: str, *tables: str) -> Lake:
    """A lake with those of the operational tables that a view reads, and the views."""
    d = Domain(spark, sf_dir)
    makers = {
        "inventory": d.inventory,
        "products": d.products,
        "locations": d.locations,
        "sale_lines": lambda: d.sale_lines().select("order_date", "location_id", "product_id", "qty_fulfilled", "line_total_eur"),
        "purchase_orders": d.purchase_lines,
        "suppliers": d.suppliers,
    }
    lake = Lake.scratch(spark, label)
    views.store_operational(lake, {name: makers[name]() for name in tables})
    views.register(lake, views.VIEWS)
    return lake


def view_inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = operational_lake(spark, sf_dir, "view-stock", "inventory", "products", "locations")
    numbers = ["qty_on_hand", "qty_reserved", "qty_available", "min_stock_level", "reorder_point", "max_stock_level"]
    return as_doubles(lake.read(views.INVENTORY_STATUS), *numbers)


def view_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = operational_lake(spark, sf_dir, "view-sales", "sale_lines", "products", "locations")
    return as_doubles(lake.read(views.DAILY_SALES), "total_qty_sold", "total_revenue_eur")


def view_supplier_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = operational_lake(spark, sf_dir, "view-suppliers", "purchase_orders", "suppliers")
    return as_doubles(lake.read(views.SUPPLIER_PERFORMANCE), "on_time_rate")


def derived_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three loads that derive movements (opening stock, sales, receipts), written to the table of movements; done twice they are there once."""
    lake = Lake.scratch(spark, "derived")
    rows = ledger(spark, sf_dir)
    for _ in range(2):
        marts.store_derived(lake, "inventory_movements", rows)
    return as_doubles(lake.read("inventory_movements"), "qty_delta")


_SERIES_DAILY = f"""{sql.SALE_LINES.strip()}, {sql.PRODUCTS.strip()}, {sql.LOCATIONS.strip()},
daily AS (
    SELECT category, region, order_date AS demand_date, SUM(qty_ordered) AS qty
    FROM sale_lines JOIN products USING (product_id) JOIN locations USING (location_id) GROUP BY 1, 2, 3),
spine AS (
    SELECT category, region, CAST(unnest(generate_series(MIN(demand_date), (SELECT MAX(demand_date) FROM daily), INTERVAL 1 DAY)) AS DATE) AS demand_date
    FROM daily GROUP BY 1, 2),
dense AS (
    SELECT category, region, demand_date, CAST(COALESCE(qty, 0) AS DOUBLE) AS qty, datediff('day', DATE '1970-01-01', demand_date) % 7 AS weekday,
        row_number() OVER (PARTITION BY category, region ORDER BY demand_date) AS i
    FROM spine LEFT JOIN daily USING (category, region, demand_date))"""
_LOTS = (
    sql.with_(sql.SALE_LINES, sql.INVENTORY, sql.PURCHASE_LINES, sql.LEDGER)
    + """, issued AS (SELECT product_id, location_id, -SUM(qty_delta) AS out FROM ledger WHERE qty_delta < 0 GROUP BY 1, 2),
received AS (
    SELECT product_id, location_id, movement_id, movement_ts, qty_delta,
        SUM(qty_delta) OVER (PARTITION BY product_id, location_id ORDER BY movement_ts, movement_id, qty_delta ROWS UNBOUNDED PRECEDING) AS high
    FROM ledger WHERE qty_delta > 0),
lots AS (
    SELECT product_id, location_id, movement_id AS lot_id, movement_ts AS received_at, qty_delta AS qty_received,
        greatest(0, least(high, COALESCE(out, 0)) - (high - qty_delta)) AS qty_issued
    FROM received LEFT JOIN issued USING (product_id, location_id)
    UNION ALL
    SELECT product_id, location_id, NULL, NULL, 0, out - COALESCE(total, 0)
    FROM issued LEFT JOIN (SELECT product_id, location_id, MAX(high) AS total FROM received GROUP BY 1, 2) USING (product_id, location_id)
    WHERE out > COALESCE(total, 0))
"""
)

QUERIES = {
    "forecast_smoothed": (
        forecast_smoothed,
        f"""WITH RECURSIVE {_SERIES_DAILY},
smooth AS (
    SELECT category, region, i, qty AS level, [0.0::DOUBLE, 0, 0, 0, 0, 0, 0] AS season FROM dense WHERE i = 1
    UNION ALL
    SELECT category, region, i, level, list_transform(range(7), lambda k: CASE WHEN k = weekday THEN {GAMMA} * (qty - level) + {1 - GAMMA} * old ELSE season[k + 1] END)
    FROM (
        SELECT d.category, d.region, d.i, d.qty, d.weekday, s.season, s.season[d.weekday + 1] AS old,
            {ALPHA} * (d.qty - s.season[d.weekday + 1]) + {1 - ALPHA} * s.level AS level
        FROM smooth s JOIN dense d ON d.category = s.category AND d.region = s.region AND d.i = s.i + 1)),
ends AS (SELECT * FROM smooth QUALIFY row_number() OVER (PARTITION BY category, region ORDER BY i DESC) = 1),
ahead AS (SELECT CAST((SELECT MAX(demand_date) FROM daily) + CAST(h AS INTEGER) AS DATE) AS forecast_date FROM range(1, {HORIZON + 1}) t(h))
SELECT category, region, forecast_date, round(level + season[datediff('day', DATE '1970-01-01', forecast_date) % 7 + 1], 4) AS forecast_qty
FROM ends, ahead""",
    ),
    "stock_age_fifo": (
        stock_age_fifo,
        _LOTS
        + """SELECT product_id, location_id, lot_id, received_at, CAST(qty_received AS DOUBLE) AS qty_received, CAST(qty_issued AS DOUBLE) AS qty_issued,
    CAST(qty_received - qty_issued AS DOUBLE) AS qty_left
FROM lots""",
    ),
    "stock_age_value": (
        stock_age_value,
        _LOTS
        + f""", {sql.PRODUCTS.strip()}, aged AS (
    SELECT product_id, location_id, SUM(qty_received - qty_issued) AS qty_on_hand,
        SUM(qty_received - qty_issued) FILTER (WHERE lot_id IS NOT NULL AND qty_received > qty_issued) AS in_lots,
        SUM((qty_received - qty_issued) * datediff('day', CAST(received_at AS DATE), DATE '{AS_OF}')) FILTER (WHERE lot_id IS NOT NULL AND qty_received > qty_issued) AS qty_days,
        MIN(CAST(received_at AS DATE)) FILTER (WHERE lot_id IS NOT NULL AND qty_received > qty_issued) AS oldest
    FROM lots GROUP BY 1, 2)
SELECT product_id, location_id, CAST(qty_on_hand AS DOUBLE) AS qty_on_hand, CAST(qty_days AS DOUBLE) / CAST(in_lots AS DOUBLE) AS mean_age_days, oldest,
    CAST(round(COALESCE(in_lots, 0) * unit_price_eur, 2) AS DOUBLE) AS value_eur
FROM aged JOIN products USING (product_id)""",
    ),
    "safety_stock": (
        safety_stock,
        f"""WITH {_SERIES_DAILY},
lead AS (
    SELECT category, region, i, SUM(qty) OVER (PARTITION BY category, region ORDER BY i ROWS BETWEEN {LEAD_DAYS - 1} PRECEDING AND CURRENT ROW) AS level FROM dense),
spread AS (
    SELECT category, region, COUNT(*) AS n_days, quantile_disc(level, {SERVICE}) AS covered_qty, SUM(level) / COUNT(*) AS mean_qty
    FROM lead WHERE i >= {LEAD_DAYS} GROUP BY 1, 2)
SELECT *, greatest(covered_qty - mean_qty, 0) AS safety_stock FROM spread""",
    ),
    "demand_runs": (
        demand_runs,
        sql.with_(sql.SALE_LINES)
        + """, daily AS (SELECT product_id, location_id, order_date AS on_day, SUM(qty_ordered) AS qty FROM sale_lines GROUP BY 1, 2, 3),
next AS (
    SELECT *, COALESCE(lead(on_day) OVER (PARTITION BY product_id, location_id ORDER BY on_day) - 1, (SELECT MAX(on_day) FROM daily)) AS until FROM daily)
SELECT product_id, location_id, on_day AS first_day, on_day AS last_day, CAST(qty AS DOUBLE) AS demand_qty FROM next
UNION ALL
SELECT product_id, location_id, CAST(on_day + 1 AS DATE), CAST(until AS DATE), 0 FROM next WHERE until > on_day""",
    ),
    "demand_trailing": (
        demand_trailing,
        sql.with_(sql.SALE_LINES)
        + f""", daily AS (SELECT product_id, location_id, order_date AS demand_date, SUM(qty_ordered) AS qty FROM sale_lines GROUP BY 1, 2, 3),
began AS (SELECT product_id, location_id, MIN(demand_date) AS began FROM daily GROUP BY 1, 2)
SELECT d.product_id, d.location_id, d.demand_date, CAST(d.qty AS DOUBLE) AS demand_qty,
    CASE WHEN d.demand_date > began THEN CAST((SELECT COALESCE(SUM(qty), 0) FROM daily p WHERE p.product_id = d.product_id AND p.location_id = d.location_id
        AND p.demand_date < d.demand_date AND p.demand_date >= d.demand_date - {TRAILING}) AS DOUBLE) / least({TRAILING}, datediff('day', began, d.demand_date)) END AS forecast_qty
FROM daily d JOIN began USING (product_id, location_id)""",
    ),
    "derived_loads": (
        derived_loads,
        sql.with_(sql.SALE_LINES, sql.INVENTORY, sql.PURCHASE_LINES, sql.LEDGER)
        + """SELECT movement_id, product_id, location_id, movement_type, CAST(qty_delta AS DOUBLE) AS qty_delta, ref_order_id,
    ref_order_type, movement_ts, notes FROM ledger""",
    ),
    "view_inventory_status": (view_inventory_status, mart_queries.QUERIES["inventory_status"][1]),
    "view_daily_sales": (view_daily_sales, mart_queries.QUERIES["daily_sales"][1]),
    "view_supplier_performance": (view_supplier_performance, mart_queries.QUERIES["supplier_performance"][1]),
}
