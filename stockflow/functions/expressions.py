"""Column expressions. All are built-ins, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stock status labels.
RUPTURED, BELOW_MIN, REORDER, OK = "RUPTURED", "BELOW_MIN", "REORDER", "OK"
# End of fixed values.


def money(column: Column) -> Column:
    return column.cast("decimal(12,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two sums as doubles; NULL when there is nothing to divide by."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_rate(hits: Column, total: Column, scale: int = 2) -> Column:
    """``hits / total`` rounded half up in decimal arithmetic."""
    return F.round(hits.cast("decimal(20,0)") / total.cast("decimal(20,0)"), scale)


def all_not_null(columns: Sequence[str]) -> Column:
    if not columns:
        raise ValueError("at least one key column is needed")
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def on_day(column: Column, day: Column) -> Column:
    """Same calendar day. Catalyst turns this into a pushed-down range when ``day`` is a literal."""
    return F.to_date(column) == F.to_date(day)


def period_start(column: Column, grain: str) -> Column:
    """First day of the ``day``, ``month`` or ``year`` a date falls in."""
    day = column.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def line_total(qty: Column, unit_price: Column) -> Column:
    return F.round(qty * unit_price, 2)


def fulfilment_status(qty_fulfilled: Column, qty_ordered: Column) -> Column:
    return F.when(qty_fulfilled >= qty_ordered, "fulfilled").otherwise("partial")


def stock_status(on_hand: Column, min_level: Column, reorder_point: Column) -> Column:
    """Ordered buckets on the quantity on hand; an unknown quantity counts as OK."""
    return (
        F.when(on_hand == 0, RUPTURED)
        .when(on_hand <= min_level, BELOW_MIN)
        .when(on_hand <= reorder_point, REORDER)
        .otherwise(OK)
    )


def lead_days(ordered_on: Column, delivered_on: Column) -> Column:
    return F.datediff(delivered_on.cast("date"), ordered_on.cast("date")).cast("bigint")


def receipt_time(delivery_date: Column) -> Column:
    """Goods are booked in at eight in the morning of the delivery day."""
    return delivery_date.cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 8 HOURS")


def reasons(*pairs: tuple[Column, str]) -> Column:
    """Labels of the conditions that hold, in the given order; an unknown condition does not count."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(label)) for condition, label in pairs]))
