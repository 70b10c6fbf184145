"""Gold tables: demand, stock, replenishment, forecasts and indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.expressions import ratio


def demand_daily(sales: DataFrame, keys: Sequence[str], day: str = "order_date", qty: str = "qty_ordered") -> DataFrame:
    """Demand per series and day, for days with sales."""
    return sales.groupBy(*keys, F.col(day).alias("demand_date")).agg(F.sum(qty).alias("demand_qty"))


def demand_daily_dense(
    sales: DataFrame, keys: Sequence[str], day: str = "order_date", qty: str = "qty_ordered"
) -> DataFrame:
    """Demand per series and day without gaps, from the first to the last day of each series.

    Sales are summed per day first, so the calendar is built from one row per series and day, whatever the
    number of sales. Gaps are opened by looking at the next day with sales: no second scan and no join, and the
    window of a series holds one row per day at most.
    """
    daily = demand_daily(sales, keys, day, qty)
    following = F.lead("demand_date").over(Window.partitionBy(*keys).orderBy("demand_date"))
    last = F.coalesce(F.date_sub(following, 1), F.col("demand_date"))
    days = F.explode(F.sequence(F.col("demand_date"), F.col("_last")))
    zero = F.lit(0).cast(daily.schema["demand_qty"].dataType)
    return (
        daily.withColumn("_last", last)
        .select(*keys, F.col("demand_date").alias("_sold_on"), "demand_qty", days.alias("demand_date"))
        .withColumn("demand_qty", F.when(F.col("demand_date") == F.col("_sold_on"), F.col("demand_qty")).otherwise(zero))
        .select(*keys, "demand_date", "demand_qty")
    )


def stock_on_hand(ledger: DataFrame) -> DataFrame:
    """Net stock per product and location. Transfers name only the sending side, so they are kept apart."""
    moved = F.col("movement_type") == "transfer"
    zero = F.lit(0).cast(ledger.schema["qty_delta"].dataType)
    return ledger.groupBy("product_id", "location_id").agg(
        F.sum(F.when(moved, zero).otherwise(F.col("qty_delta"))).alias("qty_on_hand"),
        F.sum(F.when(moved, F.col("qty_delta")).otherwise(zero)).alias("qty_transferred"),
        F.count(F.lit(1)).alias("n_movements"),
    )


def reorder_plan(demand: DataFrame, inventory: DataFrame, products: DataFrame, n_days: int) -> DataFrame:
    """Reorder point = mean daily demand x lead time + safety stock, and what to order at or below it.

    ``demand`` has ``total_qty`` per product and location over ``n_days`` days.
    """
    mean = ratio(F.col("total_qty"), F.lit(n_days))
    available = F.col("qty_on_hand") - F.col("qty_reserved")
    point = F.col("avg_daily_demand") * F.col("lead_time_days") + F.col("min_stock_level").cast("double")
    due = F.col("qty_on_hand").cast("double") <= F.col("reorder_point")
    need = F.greatest(F.col("max_stock_level") - available, F.lit(0).cast("decimal(12,2)"))
    return (
        inventory.drop("reorder_point")
        .join(demand, ["product_id", "location_id"], "left")
        .join(products.select("product_id", "lead_time_days"), "product_id")
        .withColumn("avg_daily_demand", F.coalesce(mean, F.lit(0.0)))
        .withColumn("reorder_point", point)
        .select(
            "product_id",
            "location_id",
            "avg_daily_demand",
            "reorder_point",
            available.alias("qty_available"),
            F.when(due, need).otherwise(F.lit(0)).cast("decimal(14,2)").alias("qty_to_order"),
        )
    )


def forecast_moving_average(dense: DataFrame, keys: Sequence[str], days: int = 28) -> DataFrame:
    """Forecast for a day = mean demand of the ``days`` days before it; NULL on the first day of a series.

    The dense table holds one row per day, so the window of a series is bounded by the calendar.
    """
    past = Window.partitionBy(*keys).orderBy("demand_date").rowsBetween(-days, -1)
    total, n = F.sum("demand_qty").over(past), F.count("demand_qty").over(past)
    return dense.withColumn("forecast_qty", ratio(total, n))


def forecast_weekday(dense: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean demand per series and weekday (1 = Sunday)."""
    return (
        dense.groupBy(*keys, F.dayofweek("demand_date").cast("bigint").alias("weekday"))
        .agg(F.sum("demand_qty").alias("_sum"), F.count(F.lit(1)).alias("n_days"))
        .select(*keys, "weekday", "n_days", ratio(F.col("_sum"), F.col("n_days")).alias("forecast_qty"))
    )


def kpi_daily(lines: DataFrame) -> DataFrame:
    """Revenue and fill rate per sale day, on-time rate per delivery day.

    Each line of ``Domain.traded_lines`` counts on its order's day and on its delivery's day, in one pass and one aggregate by day.
    """
    none, zero = F.lit(None).cast("decimal(12,2)"), F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    on_time = F.when(F.col("actual_delivery") <= F.col("expected_delivery"), one).otherwise(zero)

    def counters(day: str, revenue, ordered, fulfilled, n_lines, n_deliveries, n_on_time):
        values = zip(("revenue_eur", "qty_ordered", "qty_fulfilled", "n_lines", "n_deliveries", "n_on_time"), (revenue, ordered, fulfilled, n_lines, n_deliveries, n_on_time), strict=True)
        return F.struct(F.col(day).alias("kpi_date"), *[v.alias(n) for n, v in values])

    missing = F.lit(None).cast("bigint")
    sale = counters("order_date", F.col("line_total_eur"), F.col("qty_ordered"), F.col("qty_fulfilled"), one, missing, missing)
    delivery = counters("actual_delivery", none, none, none, missing, one, on_time)
    both = F.array(F.when(F.col("location_id").isNotNull(), sale), F.when(F.col("actual_delivery").isNotNull(), delivery))
    rows = lines.select(F.inline(F.array_compact(both)))
    per_day = rows.groupBy("kpi_date").agg(*[F.sum(c).alias(c) for c in rows.columns if c != "kpi_date"])
    return per_day.select(
        "kpi_date",
        "revenue_eur",
        "n_lines",
        ratio(F.col("qty_fulfilled"), F.col("qty_ordered")).alias("fill_rate"),
        "n_deliveries",
        ratio(F.col("n_on_time"), F.col("n_deliveries")).alias("on_time_rate"),
    )
