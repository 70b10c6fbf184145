"""Planning over demand and stock: forecasts for days to come, stock age, safety stock, and demand as runs of days."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.expressions import all_not_null, ratio
from stockflow.lake import materialise
from stockflow.operators.running import HOT_ROWS, running_sum
from stockflow.session import session_conf

EPOCH = "1970-01-01"
WEEK = 7
#: Days of a range of a series; a multiple of a week, so all whole ranges begin on the same weekday.
RANGE_DAYS = 364
STATE = WEEK + 1  # the level, and a season for each weekday
#: Buckets of the overlap join are so many times as wide as a mean lot.
LOTS_IN_BUCKET = 16
#: Shuffled bytes up to which one side of a join in a ledger is hashed in a task and not sorted; larger ones are sorted, on disk if need be.
HASH_JOIN = "64m"
#: Digits of a number that fits a bigint, and of quantities taken from lots as they are given back.
MOST_DIGITS, TOTAL_DIGITS = 18, 36


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(EPOCH).cast("date"))


# Smoothing. A day takes the state x = (level, seasons) to A x + b, where A depends on the weekday alone and b on the demand. So the days of a range come to
# one such map, ranges are worked out apart from each other, and a series is their composition.


def smoothed(state: Column, days: Column, alpha: float, gamma: float) -> Column:
    """The state after ``days`` (structs of weekday and demand), from ``state`` (an array of the level and seven seasons)."""
    keep, change = F.lit(1 - alpha), F.lit(alpha)

    def step(x: Column, day: Column) -> Column:
        season = x[day["weekday"] + 1]
        level = change * (day["demand"] - season) + keep * x[0]
        new = F.lit(gamma) * (day["demand"] - level) + F.lit(1 - gamma) * season
        return F.transform(x, lambda v, i: F.when(i == 0, level).when(i == day["weekday"] + 1, new).otherwise(v))

    return F.aggregate(days, state, step)


def unit(j: int | None) -> Column:
    return F.array(*[F.lit(1.0 if i == j else 0.0) for i in range(STATE)])


def forecast_smoothed(
    daily: DataFrame, keys: Sequence[str], horizon: int = 28, alpha: float = 0.2, gamma: float = 0.1, day: str = "demand_date", qty: str = "demand_qty", range_days: int = RANGE_DAYS
) -> DataFrame:
    """Forecast for each of the ``horizon`` days after the last day of all series: exponential smoothing with a weekly season.

    ``daily`` has a row for each series and day with demand; other days count as days without, from the first day of the series to the last day of the table. A series
    starts with its first demand as level and no seasons. A range of a series is one row with one array of at most ``range_days`` entries, whatever the length of the series.
    """
    if range_days % WEEK:
        raise ValueError("ranges must be whole weeks")
    number = day_number(F.col(day))
    rows = daily.select(*keys, number.alias("n"), F.col(qty).cast("double").alias("q"))
    last = rows.agg(F.max("n")).first()[0]
    if last is None:
        return daily.select(*keys, F.col(day).alias("forecast_date"), F.lit(None).cast("double").alias("forecast_qty")).limit(0)
    first = rows.groupBy(*keys).agg(F.min("n").alias("first"))
    own = rows.groupBy(*keys, F.floor(F.col("n") / range_days).alias("r")).agg(F.map_from_entries(F.collect_list(F.struct("n", "q"))).alias("known"))
    # Ranges of a series without any demand are there too: one row each, made from the series' first day.
    spread = first.withColumn("r", F.explode(F.sequence(F.floor(F.col("first") / range_days), F.lit(last // range_days).cast("bigint"))))
    same = [spread[k].eqNullSafe(own[k]) for k in keys]
    ranges = spread.join(own, [*same, spread["r"] == own["r"]], "left").select(*[spread[k] for k in keys], "first", spread["r"], "known")
    starts = F.col("first") >= F.col("r") * range_days  # the range that the series starts in
    low = F.greatest(F.col("first") + 1, F.col("r") * range_days).cast("int")
    high = F.least(F.lit(last), F.col("r") * range_days + (range_days - 1)).cast("int")
    weekday = lambda n: F.pmod(n, F.lit(WEEK)).cast("int")
    demand = lambda n: F.coalesce(F.col("known")[n], F.lit(0.0))
    none = F.array().cast("array<struct<weekday:int,demand:double>>")
    days = F.when(low <= high, F.transform(F.sequence(low, high), lambda n: F.struct(weekday(n).alias("weekday"), demand(n).alias("demand")))).otherwise(none)
    begin = F.when(starts, F.transform(unit(0), lambda v: v * demand(F.col("first")))).otherwise(unit(None))
    offsets = ranges.select(*keys, "r", starts.alias("starts"), F.size(days).alias("size"), smoothed(begin, days, alpha, gamma).alias("b"))
    # All ranges but the first begin on the first weekday of a range, so their matrices differ by their length alone: at most one for each.
    spark = daily.sparkSession
    lengths = sorted({range_days, last % range_days + 1})
    idle = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda n: F.struct(weekday(n).alias("weekday"), F.lit(0.0).alias("demand")))
    table = spark.createDataFrame([(n,) for n in lengths], "size int")
    matrix = table.select("size", F.array(*[smoothed(unit(j), idle, alpha, gamma) for j in range(STATE)]).alias("columns")).hint("broadcast")  # two rows at most
    maps = offsets.join(matrix, "size", "left").select(*keys, F.struct("r", "b", F.when(~F.col("starts"), F.col("columns")).alias("columns")).alias("m"))

    def compose(x: Column, m: Column) -> Column:
        moved = F.transform(m["b"], lambda b, i: b + F.aggregate(F.transform(m["columns"], lambda c, j: c[i] * x[j]), F.lit(0.0), lambda s, v: s + v))
        return F.when(m["columns"].isNull(), m["b"]).otherwise(moved)

    final = maps.groupBy(*keys).agg(F.aggregate(F.sort_array(F.collect_list("m")), unit(None), compose).alias("x"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    to = (F.lit(last) + F.col("h")).cast("int")
    value = F.col("x")[0] + F.col("x")[weekday(to) + 1]
    return final.withColumn("h", ahead).select(*keys, F.date_add(F.lit(EPOCH).cast("date"), to).alias("forecast_date"), value.alias("forecast_qty"))


# Stock age, first in first out. Receipts and issues of a product at a place each lie end to end on a line of quantity; an issue takes the lots that it overlaps.


def on_line(moves: DataFrame, keys: Sequence[str], order: Sequence[str], qty: str, hot_rows: int) -> DataFrame:
    """Add ``low`` and ``high``, the stretch of each move on the line of its key."""
    summed = running_sum(moves, keys, order, qty, "high", hot_rows)
    return summed.withColumn("low", F.col("high") - F.col(qty))


def overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], width: Column, how: str = "inner") -> DataFrame:
    """Pairs of stretches that overlap, with ``taken``, the length they share. Columns of the right side are called ``right_...``.
    With ``how`` "left" each piece of a left stretch without a pair is there too, with NULL.

    Stretches are cut at multiples of ``width`` and joined by key and piece of the line, so a key with very many stretches is spread over as many groups as it is long. A pair that meets in
    several pieces counts in the one where the overlap begins. Ends that are all whole numbers (bigint) and not negative are divided as such.
    """
    whole = all(isinstance(side.schema[c].dataType, T.LongType) for side in (left, right) for c in ("low", "high"))

    def piece(at: Column) -> Column:
        return ((at - F.pmod(at, width)) / width if whole else F.floor(at / width)).cast("bigint")

    def cut(rows: DataFrame) -> DataFrame:
        first, last = piece(F.col("low")), piece(F.col("high") - 1) if whole else (F.ceil(F.col("high") / width) - 1).cast("bigint")
        return rows.withColumn("_piece", F.explode(F.sequence(first, F.greatest(first, last))))

    other = cut(right).withColumnsRenamed({c: f"right_{c}" for c in right.columns if c not in keys})
    begin, end = F.greatest("low", "right_low"), F.least("high", "right_high")
    own, other = cut(left), other.withColumnsRenamed({c: f"_right_{c}" for c in [*keys, "_piece"]})
    same = [F.col(c) == F.col(f"_right_{c}") for c in [*keys, "_piece"]]
    met = own.join(other, reduce(and_, [*same, begin < end, piece(begin) == F.col("_piece")]), how)
    taken = F.when(F.col("_right__piece").isNotNull(), end - begin)  # the least of one end and NULL is the end
    return met.withColumn("taken", taken).drop("_piece", *[f"_right_{c}" for c in [*keys, "_piece"]])


def whole_units(moves: DataFrame, qty: str) -> int | None:
    """How many units of its last decimal place a quantity of one has, if all quantities together can be counted in them; None if they are no decimals or too large."""
    kind = moves.schema[qty].dataType
    if not isinstance(kind, T.DecimalType) or kind.precision > MOST_DIGITS:
        return None
    total = moves.agg(F.sum(F.abs(qty).cast(T.DecimalType(38, kind.scale)))).first()[0] or 0
    units = 10**kind.scale
    return units if total * units < 10**MOST_DIGITS else None


def fifo_lots(ledger: DataFrame, keys: Sequence[str] = ("product_id", "location_id"), hot_rows: int = HOT_ROWS, width: int | None = None) -> DataFrame:
    """Each lot that came in, with what first-in-first-out issues have taken from it, and one row without lot for issues that no lot covers.

    Columns: keys, lot_id, received_at, qty_received, qty_issued, qty_left. The sum of ``qty_left`` of a key is its stock on hand.

    The ledger is read once. Both lines are summed in one pass, in whole units of the last decimal place where these fit a bigint; a lot keeps its
    columns while it is matched, so nothing is joined back to it.
    """
    with session_conf(ledger.sparkSession, spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=HASH_JOIN):
        moves = materialise(ledger.where("qty_delta > 0 OR qty_delta < 0").select(*keys, "movement_id", "movement_ts", "qty_delta"), "moves")
    units = whole_units(moves, "qty_delta")
    kind = moves.schema["qty_delta"].dataType
    qty = F.abs("qty_delta") if units is None else (F.abs("qty_delta") * F.lit(units)).cast("bigint")
    sides = moves.select(*keys, (F.col("qty_delta") > 0).alias("incoming"), "movement_id", "movement_ts", qty.alias("qty"))
    line = on_line(sides, [*keys, "incoming"], ["movement_ts", "movement_id", "qty"], "qty", hot_rows)
    line = materialise(line.withColumns({c: F.when(F.col("incoming"), F.col(c)) for c in ("movement_id", "movement_ts")}), "line")
    lots, issues = line.where("incoming").drop("incoming"), line.where("NOT incoming")
    if width is None:
        mean = lots.agg(F.avg("qty").cast("double")).first()[0]
        width = math.ceil(LOTS_IN_BUCKET * (mean or 1.0))
    elif units is not None:
        width *= units
    matched = overlaps(lots, issues.select(*keys, "low", "high"), keys, F.lit(width), "left")
    used = matched.groupBy(*lots.columns).agg(F.sum("taken").alias("used"))
    zero = F.lit(0).cast(line.schema["qty"].dataType)
    gone = F.coalesce(F.col("used"), zero)
    kept = used.select(
        *keys, F.col("movement_id").alias("lot_id"), F.col("movement_ts").alias("received_at"), F.col("qty").alias("qty_received"), gone.alias("qty_issued"), (F.col("qty") - gone).alias("qty_left")
    )
    # Keys that are not set match nothing.
    covers = F.col("incoming") & all_not_null(keys)
    reach = line.groupBy(*keys).agg(F.max(F.when(~F.col("incoming"), F.col("high"))).alias("out"), F.max(F.when(covers, F.col("high"))).alias("in"))
    short = reach.withColumn("short", F.col("out") - F.coalesce("in", zero)).where("short > 0")
    missing = short.select(*keys, F.lit(None).cast("string").alias("lot_id"), F.lit(None).cast("timestamp_ntz").alias("received_at"), zero.alias("qty_received"), F.col("short").alias("qty_issued"), (-F.col("short")).alias("qty_left"))
    found = kept.unionByName(missing)
    if units is None:
        return found
    one = F.lit(Decimal(1).scaleb(-kind.scale))
    return found.withColumns({c: (F.col(c).cast(T.DecimalType(MOST_DIGITS, 0)) * one).cast(T.DecimalType(TOTAL_DIGITS if c != "qty_received" else kind.precision, kind.scale)) for c in ("qty_received", "qty_issued", "qty_left")})


def stock_age(lots: DataFrame, products: DataFrame, as_of: str, keys: Sequence[str] = ("product_id", "location_id")) -> DataFrame:
    """Per key: stock on hand, the quantity-weighted age in days of what is left, the oldest day, and its value at list price."""
    days = F.datediff(F.lit(as_of).cast("date"), F.col("received_at").cast("date"))
    left = F.col("lot_id").isNotNull() & (F.col("qty_left") > 0)
    aged = lots.groupBy(*keys).agg(
        F.sum("qty_left").alias("qty_on_hand"),
        F.sum(F.when(left, F.col("qty_left"))).alias("qty_in_lots"),
        F.sum(F.when(left, F.col("qty_left") * days)).alias("qty_days"),
        F.min(F.when(left, F.col("received_at").cast("date"))).alias("oldest"),
    )
    priced = aged.join(products.select("product_id", "unit_price_eur"), "product_id")
    value = (F.coalesce(F.col("qty_in_lots"), F.lit(0)) * F.col("unit_price_eur")).cast("decimal(28,2)")
    return priced.select(*keys, "qty_on_hand", ratio(F.col("qty_days"), F.col("qty_in_lots")).alias("mean_age_days"), "oldest", value.alias("value_eur"))


# Safety stock from the spread of demand over the lead time.


def demand_sketches(daily: DataFrame, keys: Sequence[str], lead_days: int, k: int, day: str = "demand_date", qty: str = "demand_qty") -> DataFrame:
    """A Gold table of quantile sketches: per series and month, of the demand over the ``lead_days`` days that end on each day of the month.

    Days from the lead time's end after the first demand of a series to the last day of the table count, also those without demand. Sketches of months, places or products can be
    merged to those of any union of them; ``k`` sets their size and their error.
    """
    last = daily.agg(F.max(day)).first()[0]
    changes = F.array(F.struct(F.col(day).alias("on"), F.col(qty).alias("by")), F.struct(F.date_add(day, lead_days).alias("on"), (-F.col(qty)).alias("by")))
    steps = daily.select(*keys, F.inline(changes)).groupBy(*keys, "on").agg(F.sum("by").alias("by"))
    in_order = Window.partitionBy(*keys).orderBy("on")
    level = F.sum("by").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    until = F.least(F.lit(last), F.coalesce(F.date_sub(F.lead("on").over(in_order), 1), F.lit(last)))
    first = F.min("on").over(Window.partitionBy(*keys))
    runs = steps.select(*keys, F.greatest(F.col("on"), F.date_add(first, lead_days - 1)).alias("begin"), until.alias("until"), level.cast("double").alias("level")).where("begin <= until")
    days = runs.select(*keys, "level", F.explode(F.sequence("begin", "until")).alias("on"))
    return days.groupBy(*keys, F.trunc("on", "month").alias("month")).agg(F.kll_sketch_agg_double("level", k).alias("sketch"), F.sum("level").alias("total"), F.count(F.lit(1)).alias("n"))


def safety_stock(sketches: DataFrame, keys: Sequence[str], service: float) -> DataFrame:
    """Per series: the demand over the lead time that is not passed in ``service`` of the cases, its mean, and the stock that covers the difference."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("total").alias("total"), F.sum("n").alias("n"))
    at = F.kll_sketch_get_quantile_double("sketch", F.lit(service))
    mean = ratio(F.col("total"), F.col("n"))
    return merged.select(*keys, F.col("n").alias("n_days"), at.alias("covered_qty"), mean.alias("mean_qty"), F.greatest(at - mean, F.lit(0.0)).alias("safety_stock"))


# Demand as runs: a row for each day with demand and one for each gap, however long.


def demand_runs(daily: DataFrame, keys: Sequence[str], day: str = "demand_date", qty: str = "demand_qty") -> DataFrame:
    """Demand of every series to one common last day, as runs of days with the same demand: the first day, the last, and the demand of each.

    A day with demand is a run of its own; the days after it, up to the next or to the last day of the table, are one run without demand.
    """
    last = daily.agg(F.max(day)).first()[0]
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    until = F.coalesce(F.date_sub(following, 1), F.lit(last))
    zero = F.lit(0).cast(daily.schema[qty].dataType)
    sold = F.struct(F.col(day).alias("first_day"), F.col(day).alias("last_day"), F.col(qty).alias("demand_qty"))
    gap = F.struct(F.date_add(day, 1).alias("first_day"), F.col("_until").alias("last_day"), zero.alias("demand_qty"))
    pieces = F.array(sold, F.when(F.col("_until") > F.col(day), gap))
    return daily.withColumn("_until", until).select(*keys, F.inline(F.array_compact(pieces)))


def opened(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The days of runs, one row each. The last step only: this is where series times days rows come to be."""
    return runs.select(*keys, F.explode(F.sequence("first_day", "last_day")).alias("demand_date"), "demand_qty")


def trailing_mean(daily: DataFrame, keys: Sequence[str], days: int, day: str = "demand_date", qty: str = "demand_qty") -> DataFrame:
    """At each day with demand, the mean demand per day of the ``days`` days before it, over the days since the series began.

    The window is a range of days over the rows with demand, so days without need no rows.
    """
    number = day_number(F.col(day))
    by = Window.partitionBy(*keys).orderBy(number)
    total = F.coalesce(F.sum(qty).over(by.rangeBetween(-days, -1)), F.lit(0).cast(daily.schema[qty].dataType))
    passed = F.least(F.lit(days), number - F.min(number).over(Window.partitionBy(*keys)))
    return daily.withColumn("forecast_qty", F.when(passed > 0, ratio(total, passed)))
