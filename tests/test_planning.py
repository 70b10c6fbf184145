"""Planning operators against plain recursions and sweeps, with hot keys and odd widths."""

import bisect
import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockflow.plans import gold, planning
from stockflow.queries import planning as queries

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.timedelta(days=1)


def demand(spark, series):
    """series: {key: {day: qty}}"""
    rows = [(k, d, Decimal(q)) for k, days in series.items() for d, q in days.items()]
    return spark.createDataFrame(rows, "k string, demand_date date, demand_qty decimal(12,2)")


def random_series(rng, first, days, share):
    return {first + n * DAY: rng.randint(1, 50) for n in range(days) if n == 0 or rng.random() < share}


def smoothed(days, last, horizon, alpha, gamma):
    day = min(days)
    level, season = float(days[day]), [0.0] * 7
    while day < last:
        day += DAY
        w, y = (day - dt.date(1970, 1, 1)).days % 7, float(days.get(day, 0))
        level = alpha * (y - season[w]) + (1 - alpha) * level
        season[w] = gamma * (y - level) + (1 - gamma) * season[w]
    return [level + season[(last + h * DAY - dt.date(1970, 1, 1)).days % 7] for h in range(1, horizon + 1)]


@pytest.mark.parametrize("range_days", [7, 28, 364])
def test_smoothing_in_ranges_is_the_recursion(spark, range_days):
    rng = random.Random(1)
    first = dt.date(2020, 2, 20)
    series = {
        "long": random_series(rng, first, 400, 0.5),
        "sparse": random_series(rng, first + 3 * DAY, 390, 0.02),
        "short": {first + 399 * DAY: 5},
        "early": {first: 9},
        None: random_series(rng, first + 100 * DAY, 50, 1.0),
    }
    last = max(d for days in series.values() for d in days)
    found = defaultdict(dict)
    for r in planning.forecast_smoothed(demand(spark, series), ["k"], 10, 0.3, 0.2, range_days=range_days).collect():
        found[r.k][r.forecast_date] = r.forecast_qty
    assert set(found) == set(series)
    for k, days in series.items():
        want = smoothed(days, last, 10, 0.3, 0.2)
        assert sorted(found[k]) == [last + h * DAY for h in range(1, 11)]
        assert [found[k][d] for d in sorted(found[k])] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_nothing_to_forecast(spark):
    assert planning.forecast_smoothed(demand(spark, {}), ["k"]).collect() == []
    with pytest.raises(ValueError):
        planning.forecast_smoothed(demand(spark, {}), ["k"], range_days=10)


LEDGER = "product_id long, location_id long, movement_id string, movement_ts timestamp_ntz, qty_delta decimal(13,2)"


def moves(rng, product, n, at):
    return [(product, 1, f"{product}-{i}", at + i * dt.timedelta(hours=1), Decimal(rng.randint(-900, 1000)) / 100) for i in range(n)]


def fifo(rows):
    lots, out, short = [], [], Decimal(0)
    for _, _, m, ts, q in sorted((r for r in rows if r[4] > 0), key=lambda r: (r[3], r[2])):
        lots.append([m, ts, q, q])
    gone = sum((-r[4] for r in rows if r[4] < 0), Decimal(0))
    for lot in lots:
        taken = min(lot[3], gone)
        lot[3] -= taken
        gone -= taken
    short = gone
    out = [(m, ts, q, q - left, left) for m, ts, q, left in lots]
    return out + ([(None, None, Decimal(0), short, -short)] if short else [])


@pytest.mark.parametrize("hot_rows,width", [(2_000_000, None), (50, 1), (50, 100_000)])
def test_lots_first_in_first_out(spark, hot_rows, width):
    rng, at = random.Random(2), dt.datetime(2024, 1, 1)
    rows = moves(rng, 1, 400, at) + moves(rng, 2, 30, at) + [(3, 1, "in", at, Decimal(5))] + [(4, 1, "out", at, Decimal(-7))]
    rows += [(5, 1, "big", at, Decimal(5000))] + [(5, 1, f"o{i}", at, Decimal(-1)) for i in range(40)]
    lots = planning.fifo_lots(spark.createDataFrame(rows, LEDGER), hot_rows=hot_rows, width=width).collect()
    for product in range(1, 6):
        own = [r for r in rows if r[0] == product]
        got = sorted(((r.lot_id, r.received_at, r.qty_received, r.qty_issued, r.qty_left) for r in lots if r.product_id == product), key=str)
        assert got == sorted(fifo(own), key=str)
        assert sum(r.qty_left for r in lots if r.product_id == product) == sum(r[4] for r in own)


def test_what_is_left_is_the_stock_on_hand(spark):
    ledger = queries.ledger(spark, SF_DIR)
    left = planning.fifo_lots(ledger).groupBy("product_id", "location_id").agg(F.sum("qty_left").alias("left"))
    stock = gold.stock_on_hand(ledger)
    wrong = stock.join(left, ["product_id", "location_id"], "left").where("coalesce(left, 0) <> qty_on_hand")  # keys that never moved anything have no lots
    assert stock.count() > 0 and wrong.count() == 0


def test_lots_read_the_ledger_once(spark, tmp_path):
    """The ledger is the costly part: each of its rows is made once, whatever is summed and matched after that."""
    rows = moves(random.Random(5), 1, 300, dt.datetime(2024, 1, 1))
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    ledger = spark.createDataFrame(rows, LEDGER)
    lots = planning.fifo_lots(ledger.mapInArrow(counted, ledger.schema)).collect()
    assert made.value == len(rows)
    assert sum(r.qty_left for r in lots) == sum(r[4] for r in rows)


@pytest.mark.parametrize("qty", ["decimal(38,2)", "double", "decimal(13,2)"])
def test_lots_of_other_quantities(spark, qty):
    """Quantities that are no decimals, or too large to be counted in their last place, are summed as they are; keys that are not set match nothing."""
    rows = [(1, 1, "in", 1, 5.25), (1, 1, "more", 2, 3.5), (1, 1, "out", 3, -6.0), (None, 1, "in", 1, 2.0), (None, 1, "out", 2, -0.5), (2, 1, "none", 1, None)]
    ledger = spark.createDataFrame(rows, "product_id long, location_id long, movement_id string, d int, q double").select(
        "product_id", "location_id", "movement_id", F.expr("CAST(date_add(DATE'2024-01-01', d) AS TIMESTAMP_NTZ)").alias("movement_ts"), F.col("q").cast(qty).alias("qty_delta")
    )
    found = sorted(((r.product_id or 0, r.lot_id or "", float(r.qty_received), float(r.qty_issued), float(r.qty_left)) for r in planning.fifo_lots(ledger).collect()))
    assert found == [(0, "", 0.0, 0.5, -0.5), (0, "in", 2.0, 0.0, 2.0), (1, "in", 5.25, 5.25, 0.0), (1, "more", 3.5, 0.75, 2.75)]


def test_quantities_too_large_for_whole_units(spark):
    big = Decimal("99999999999.99")
    rows = [(1, 1, f"m{i}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), big) for i in range(100_001)] + [(1, 1, "z", dt.datetime(2025, 1, 1), -big)]
    ledger = spark.createDataFrame(rows, LEDGER)
    assert planning.whole_units(ledger, "qty_delta") is None and planning.whole_units(ledger.where("movement_id = 'z'"), "qty_delta") == 100
    assert planning.fifo_lots(ledger).agg(F.sum("qty_left")).first()[0] == 100_000 * big


def test_overlaps_make_no_cross_join(spark):
    """A product with many lots: candidates grow with the lots, not with their square."""
    rows = [(1, f"m{i}", Decimal(1)) for i in range(2000)]
    line = spark.createDataFrame([(p, m, q, Decimal(i), Decimal(i + 1)) for i, (p, m, q) in enumerate(rows)], "product_id long, m string, qty decimal(12,2), low decimal(12,2), high decimal(12,2)")
    met = planning.overlaps(line, line, ["product_id"], F.lit(16))
    assert met.count() == 2000
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    pieces = line.withColumn("p", F.floor(F.col("low") / 16)).groupBy("p").count().agg(F.max("count")).first()[0]
    assert pieces == 16


def lead_demand(days, last, lead):
    first = min(days)
    out, day = [], first + (lead - 1) * DAY
    while day <= last:
        out.append(float(sum(days.get(day - n * DAY, 0) for n in range(lead))))
        day += DAY
    return out


def test_safety_stock_within_the_error_of_its_sketches(spark):
    rng, first = random.Random(3), dt.date(2018, 1, 7)
    series = {"a": random_series(rng, first, 2500, 0.7), "b": random_series(rng, first + 40 * DAY, 700, 0.1), "c": {first + 2499 * DAY: 4}}
    last = first + 2499 * DAY
    series["a"].setdefault(last, 1)
    daily = demand(spark, series)
    exact = {k: sorted(lead_demand(days, last, 14)) for k, days in series.items()}
    for k_size, allowed in ((4096, 0.0), (200, 0.0133)):
        found = {r.k: r for r in planning.safety_stock(planning.demand_sketches(daily, ["k"], 14, k_size), ["k"], 0.95).collect()}
        assert set(found) == {"a", "b"}  # c has not lived a lead time
        for k, r in found.items():
            own = exact[k]
            assert r.n_days == len(own) and r.mean_qty == pytest.approx(sum(own) / len(own))
            low, high = (f(own, r.covered_qty) / len(own) for f in (bisect.bisect_left, bisect.bisect_right))
            assert low - allowed <= 0.95 <= high + allowed + 1 / len(own)
            assert r.safety_stock == pytest.approx(max(0.0, r.covered_qty - r.mean_qty))


def test_sketches_of_months_merge_to_those_of_the_whole(spark):
    rng, first = random.Random(4), dt.date(2018, 1, 7)
    daily = demand(spark, {k: random_series(rng, first, 300, 0.5) for k in "ab"})
    parts = planning.demand_sketches(daily, ["k"], 7, 4096)
    assert parts.count() > 10 and parts.agg(F.sum("n")).first()[0] == parts.agg(F.sum(F.kll_sketch_get_n_double("sketch"))).first()[0]
    both = planning.safety_stock(parts.withColumn("all", F.lit(1)), ["all"], 0.5).first()
    assert both.n_days == parts.agg(F.sum("n")).first()[0]


def test_runs_open_to_the_calendar(spark):
    rng, first = random.Random(5), dt.date(2020, 1, 1)
    series = {"a": random_series(rng, first, 100, 0.2), "b": {first + 5 * DAY: 3}, "c": {first + n * DAY: 1 for n in range(120)}}
    last = first + 119 * DAY
    runs = planning.demand_runs(demand(spark, series), ["k"])
    assert runs.count() <= 2 * sum(len(d) for d in series.values())
    got = {(r.k, r.demand_date): r.demand_qty for r in planning.opened(runs, ["k"]).collect()}
    want = {(k, min(days) + n * DAY): Decimal(days.get(min(days) + n * DAY, 0)) for k, days in series.items() for n in range((last - min(days)).days + 1)}
    assert got == want
    assert "Generate explode" not in runs._jdf.queryExecution().executedPlan().toString()


def test_trailing_mean_is_that_of_the_calendar(spark):
    rng, first = random.Random(6), dt.date(2020, 1, 1)
    series = {"a": random_series(rng, first, 100, 0.3), "b": {first: 3, first + 90 * DAY: 4}}
    daily = demand(spark, series)
    dense = gold.demand_daily_dense(daily.withColumnRenamed("demand_qty", "q"), ["k"], "demand_date", "q")
    want = {(r.k, r.demand_date): r.forecast_qty for r in gold.forecast_moving_average(dense, ["k"], 28).collect()}
    for r in planning.trailing_mean(daily, ["k"], 28).collect():
        expected = want[r.k, r.demand_date]
        assert (r.forecast_qty is None) == (expected is None)
        assert expected is None or r.forecast_qty == pytest.approx(expected)
