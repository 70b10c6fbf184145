"""Streams that break off between their sinks, come again, and hand over to the batch layer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import PERIOD, Lake
from stockflow.model import SALES
from stockflow.plans import layers
from stockflow.plans.gold_tables import AdditiveGold
from stockflow.plans.serving import Handover, period_end
from stockflow.queries import live, loading
from stockflow.sources import landing
from stockflow.streaming import ingest
from stockflow.streaming.guarded import GuardedLoad, landing_stream
from stockflow.streaming.late import WindowedTotals
from stockflow.streaming.ledger import BEGUN, DONE, BatchLedger, Entry
from stockflow.streaming.reconcile import reconcile

SCHEMA = T.StructType().add("id", "long").add("at", "timestamp").add("kind", "string").add("v", "long")
HOUR = dt.timedelta(hours=1)


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


BATCHES = [
    [(1, at(1, 5), "a", 1), (2, at(1, 50), "a", 2), (3, None, "a", 4)],
    [(4, at(1, 59), "a", 8), (5, at(5), "b", 16)],
    [(6, at(4, 1), "a", 32), (7, at(2, 59), "a", 64), (8, at(3), "b", None)],
    [(9, at(1, 1), "a", 128), (10, at(9), "c", 256)],
]
ON_TIME = [(1, "a", 3, 11), (3, "b", 1, None), (4, "a", 1, 32), (5, "b", 1, 16), (9, "c", 1, 256)]
FOLDED = [(1, "a", 4, 139), (2, "a", 1, 64), (3, "b", 1, None), (4, "a", 1, 32), (5, "b", 1, 16), (9, "c", 1, 256)]


class Totals:
    """A stream of ``BATCHES``, one file and one micro-batch each."""

    def __init__(self, spark, tmp_path, label):
        self.spark, self.folder = spark, str(tmp_path / label)
        self.lake = Lake.scratch(spark, label)
        self.totals = WindowedTotals(self.lake, "w", SCHEMA, "at", ["kind"], "v", HOUR, 2 * HOUR)

    def write(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def run(self):
        stream = ingest.file_stream(self.spark, self.folder, SCHEMA, maxFilesPerTrigger="1")
        ingest.run_available(self.totals.stream(stream, f"{self.lake.root}-c"))

    def shown(self):
        return sorted(((r.window_start.hour, r.kind, r.n_events, r.total_value) for r in self.totals.windows().collect()), key=str)

    def late(self):
        return sorted(r.id for r in self.lake.read("w_late").collect())

    def accounts(self):
        done = BatchLedger(self.lake, "w").lines().where(F.col("state") == DONE)
        return sorted((r.batch_id, r.landed, r.accepted, r.set_aside) for r in done.collect())


def test_late_events_are_kept_and_folded_once(spark, tmp_path):
    t = Totals(spark, tmp_path, "folded")
    for rows in BATCHES:
        t.write(rows)
        t.run()
    # The third batch ran with a watermark of three, so the hour from two to three is closed, and the hour from three is not.
    assert t.shown() == ON_TIME and t.late() == [3, 7, 9]
    assert t.accounts() == [(0, 3, 2, 1), (1, 2, 2, 0), (2, 3, 2, 1), (3, 2, 1, 1)]
    assert t.totals.fold_late() > 0
    assert t.shown() == FOLDED
    t.totals.fold_late()
    assert t.shown() == FOLDED


def test_a_stream_that_breaks_off_anywhere_gives_the_same_tables(spark, tmp_path, monkeypatch):
    t = Totals(spark, tmp_path, "broken")
    writes, plain = [0], Lake.replace_partitions
    note = BatchLedger.note

    def failing(*args, **kwargs):
        writes[0] += 1
        if writes[0] in (2, 5):
            raise OSError("the sink is gone")
        return plain(*args, **kwargs)

    def failing_note(self, batch_id, entry):
        if entry.state == DONE and batch_id == 1 and not failing_note.failed:
            failing_note.failed = True
            raise OSError("the ledger is gone")
        return note(self, batch_id, entry)

    failing_note.failed = False
    monkeypatch.setattr(Lake, "replace_partitions", failing)
    monkeypatch.setattr(BatchLedger, "note", failing_note)
    for rows in BATCHES:
        t.write(rows)
        for _ in range(4):
            try:
                t.run()
                break
            except Exception as error:  # noqa: BLE001
                assert "is gone" in str(error)
    assert writes[0] > 8 and failing_note.failed
    assert t.shown() == ON_TIME and t.late() == [3, 7, 9]
    t.totals.take(spark.createDataFrame(BATCHES[0], SCHEMA), 0)  # a batch that is done comes again
    assert t.shown() == ON_TIME and t.late() == [3, 7, 9]


def test_settled_parts_are_the_same_windows(spark, tmp_path, monkeypatch):
    t = Totals(spark, tmp_path, "settled")
    for rows in BATCHES[:2]:
        t.write(rows)
        t.run()
    before = t.shown()
    held = t.totals.windows()
    plan = sorted(tuple(r) for r in held.collect())
    with monkeypatch.context() as broken:
        broken.setattr(Lake, "append", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            t.totals.settle()
    assert t.shown() == before  # a new part is there, and nobody reads it
    with monkeypatch.context() as broken:
        broken.setattr(Lake, "drop_labels", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            t.totals.settle()
    assert t.shown() == before  # the old parts are still there, and nobody reads them
    assert sorted(tuple(r) for r in held.collect()) == plan  # a reader that began before goes on
    t.totals.settle()
    assert t.shown() == before and len(t.totals.labels("w_parts", "part")) == 1
    for rows in BATCHES[2:]:
        t.write(rows)
        t.run()
    t.totals.fold_late()
    t.totals.settle()
    t.totals.fold_late()
    assert t.shown() == FOLDED
    t.totals.settle(since=at(4))
    assert t.shown() == [w for w in FOLDED if w[0] >= 4]


def test_ledger_tells_new_begun_and_done(spark):
    ledger = BatchLedger(Lake.scratch(spark, "ledger"), "s")
    assert ledger.entry(0) is None and ledger.newest_before(0) is None
    ledger.note(0, Entry(BEGUN, watermark_us=5))
    assert ledger.entry(0) == Entry(BEGUN, watermark_us=5)
    ledger.note(0, Entry(DONE, 5, 9, 3, 2, 1))
    assert ledger.entry(0).state == DONE and ledger.newest_before(1) == 9 and ledger.newest_before(0) is None
    assert BatchLedger(ledger.lake, "other").entry(0) is None


def sales_row(order, total="10.00", export="2024-01-01 18:00:00", date="2024-01-01"):
    return (order, f"{date} 09:00:00", date, "fulfilled", "phone", "1", "C1", "Name", "plumber", "1", "LOC-01", "P1", "SKU", "1.00", "1.00", "10.00", total, total, export)


def guarded(spark, label, broken=None):
    """Three exports through the stream; the sinks named in ``broken`` fail once each."""
    lake = Lake.scratch(spark, label)
    load = GuardedLoad(lake, SALES, "s", "2024-02-01 00:00:00", grain="year")
    for name in broken or ():
        failing_once(load, name)
    exports = [
        [sales_row("1"), sales_row("2", "abc"), sales_row(None), sales_row("3", "1.00")],
        [sales_row("3", "2.00", "2024-01-02 18:00:00"), sales_row("3", "3.00", "2024-01-02 19:00:00"), sales_row("4")],
        [sales_row("5", date="2023-05-05"), sales_row("6", "1e99")],
    ]
    stamps = ["2024-01-01 18:00:00", "2024-01-02 18:00:00", "2024-01-03 18:00:00"]
    for rows, stamp in zip(exports, stamps, strict=True):
        frame = spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in SALES.landing_columns]))
        landing.export_csv(frame, f"{lake.root}-in", SALES.name, F.lit(stamp).cast("timestamp"))
        for _ in range(5):
            try:
                ingest.run_available(load.stream(landing_stream(spark, SALES, f"{lake.root}-in/*", maxFilesPerTrigger="10"), f"{lake.root}-c"))
                break
            except Exception as error:  # noqa: BLE001
                assert "is gone" in str(error)
    bronze = sorted((r.order_id, r.line_total_eur) for r in lake.read(layers.bronze_table(SALES)).collect())
    rejects = sorted(str((r.order_id, r.source_file, r.reasons)) for r in lake.read(load.rejects_table).collect())
    accounts = sorted((r.source_file, r.landed, r.accepted, r.rejected, r.superseded) for r in lake.read(load.accounting_table).drop("batch").collect())
    return bronze, rejects, accounts


def failing_once(load, name):
    plain = getattr(load, name)
    state = []

    def write(rows):
        if not state:
            state.append(1)
            raise OSError("the sink is gone")
        plain(rows)

    setattr(load, name, write)


def test_stream_with_rejects_accounts_for_every_row(spark):
    bronze, rejects, accounts = guarded(spark, "guarded")
    assert bronze == [("1", 10.0), ("3", 3.0), ("4", 10.0), ("5", 10.0)]
    assert len(rejects) == 3
    assert [a[1:] for a in accounts] == [(4, 2, 2, 0), (3, 2, 0, 1), (2, 1, 1, 0)]


def test_a_killed_and_restarted_load_gives_the_same_three_tables(spark):
    assert guarded(spark, "killed", ["write_rejects", "write_accepted", "write_accounting"]) == guarded(spark, "whole")


def test_reconciliation_of_streams_is_that_of_tables(spark, tmp_path):
    sold = [(k, at(k % 20, day=1 + k // 20), 1) for k in range(40) if k % 5]
    moved = [(k, at(k % 20, 30, day=1 + k // 20) + (dt.timedelta(days=2) if k % 7 == 0 else dt.timedelta()), 1) for k in range(40) if k % 3]
    schemas = ["k long, sold_at timestamp, q long", "k long, moved_at timestamp, m long"]
    tables = [spark.createDataFrame(rows, s) for rows, s in zip((sold, moved), schemas, strict=True)]
    want = sorted(str(tuple(r)) for r in reconcile(*tables, ["k"], "sold_at", "moved_at", "1 hour", "4 days").collect())
    out, check = str(tmp_path / "out"), str(tmp_path / "c")
    end = dt.datetime(2100, 1, 1)
    for begin in (0, 15, 30, None):
        for name, rows, schema in zip("sm", (sold, moved), schemas, strict=True):
            own = [(None, end, None)] if begin is None else [r for r in rows if begin <= r[0] < begin + 15]
            spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        streams = [ingest.file_stream(spark, str(tmp_path / n), t.schema) for n, t in zip("sm", tables, strict=True)]
        with ingest.disk_state(spark):
            ingest.run_available(ingest.append_parquet(reconcile(*streams, ["k"], "sold_at", "moved_at", "1 hour", "4 days"), out, check))
    got = spark.read.parquet(out).where("k IS NOT NULL")
    assert sorted(str(tuple(r)) for r in got.select("k", "sold_at", "q", "moved_at", "m", "status").collect()) == sorted(
        str(tuple(r)) for r in reconcile(*tables, ["k"], "sold_at", "moved_at", "1 hour", "4 days").select("k", "sold_at", "q", "moved_at", "m", "status").collect()
    )
    assert len(want) == got.count() and {r.status for r in got.collect()} == {"matched", "sold_only", "moved_only"}


def silver(spark, lake, rows):
    """Silver sales as a promotion leaves them, with the notes of its periods."""
    schema = SALES.silver_schema()
    blank = {f.name: None for f in schema}
    full = [tuple({**blank, "order_id": o, "order_date": d, "product_id": p, "location_code": "L", "sku": p, "qty_fulfilled": q, "line_total_eur": t}.values()) for o, d, p, q, t in rows]
    from stockflow.model import CHANGES

    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    frame = spark.createDataFrame(full, loose)
    for table in (layers.bronze_table(SALES), layers.silver_table(SALES)):
        lake.ensure_by_date(table, schema, "month")
    dated = frame.withColumn(PERIOD, F.trunc("order_date", "month"))
    lake.replace_partitions(layers.silver_table(SALES), dated)
    lake.ensure(layers.promoted_table(SALES), CHANGES)
    notes = dated.select(F.expr("uuid()").alias("load_id"), PERIOD).groupBy(PERIOD).agg(F.first("load_id").alias("load_id")).select("load_id", PERIOD)
    lake.append(layers.promoted_table(SALES), notes)


def money(x):
    from decimal import Decimal

    return Decimal(x).quantize(Decimal("0.01"))


def gold_of(lake):
    return AdditiveGold(lake, SALES, ["order_date", "location_code", "product_id", "sku"], ["product_id", "location_code"], {"qty": "qty_fulfilled", "eur": "line_total_eur"}, buckets=3)


JAN, FEB, MAR = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)


def totals(gold):
    return sorted((r.product_id, r.qty, r.eur, r.n_rows) for r in gold.totals().collect())


def rebuilt(lake):
    rows = lake.read(layers.silver_table(SALES)).groupBy("product_id").agg(F.sum("qty_fulfilled").alias("q"), F.sum("line_total_eur").alias("e"), F.count("*").alias("n"))
    return sorted((r.product_id, r.q, r.e, r.n) for r in rows.collect())


def test_gold_follows_changes(spark):
    lake = Lake.scratch(spark, "gold")
    silver(spark, lake, [("1", JAN, "p", money(1), money(10)), ("2", FEB, "p", money(2), money(20)), ("3", FEB, "q", money(3), money(30))])
    gold = gold_of(lake)
    assert gold.refresh() == 1 and totals(gold) == rebuilt(lake)
    assert gold.refresh() is None
    silver(spark, lake, [("2", FEB, "p", money(5), money(50)), ("4", MAR, "r", money(1), money(1))])  # q has lost its rows
    assert gold.refresh() == 2 and totals(gold) == rebuilt(lake)
    assert [t[0] for t in totals(gold)] == ["p", "r"]
    daily = sorted((r.order_date, r.product_id, r.qty) for r in lake.read(gold.daily).collect())
    assert daily == [(JAN, "p", money(1)), (FEB, "p", money(5)), (MAR, "r", money(1))]


def test_gold_reads_only_changed_periods(spark):
    lake = Lake.scratch(spark, "goldplan")
    silver(spark, lake, [(str(k), dt.date(2024, m, 3), "p", money(1), money(1)) for k, m in enumerate(range(1, 8))])
    gold = gold_of(lake)
    changed = gold.silver_of([dt.date(2024, 3, 1)])
    assert len(changed.inputFiles()) < len(lake.read(layers.silver_table(SALES)).inputFiles())
    assert "PartitionFilters: [period" in changed._jdf.queryExecution().executedPlan().toString().replace("isnotnull(period#", "period#").replace("(period", "period")


@pytest.mark.parametrize("step,calls_of_a_run", [("replace_partitions", 4), ("append", 2), ("drop_labels", 3)])
def test_a_broken_refresh_is_ended_by_the_next(step, calls_of_a_run, spark, monkeypatch):
    lake = Lake.scratch(spark, f"goldbroken{step.replace('_', '')}")
    rows = [("1", JAN, "p", money(1), money(10)), ("2", FEB, "q", money(2), money(20))]
    silver(spark, lake, rows)
    gold = gold_of(lake)
    gold.refresh()
    plain = getattr(Lake, step)
    for breaks_at in range(1, calls_of_a_run + 1):
        silver(spark, lake, [("2", FEB, "q", money(2 + breaks_at), money(20)), (f"x{breaks_at}", MAR, "r", money(1), money(1))])
        calls = [0]

        def failing(*args, _plain=plain, _calls=calls, _at=breaks_at, **kwargs):
            _calls[0] += 1
            if _calls[0] == _at:
                raise OSError("gone")
            return _plain(*args, **kwargs)

        with monkeypatch.context() as broken:
            broken.setattr(Lake, step, failing)
            try:
                gold.refresh()
            except OSError:
                pass
        # More has changed before the broken run is ended.
        silver(spark, lake, [("1", JAN, "p", money(breaks_at), money(breaks_at))])
        gold.refresh()
        assert totals(gold) == rebuilt(lake)


def test_period_ends():
    assert period_end(dt.date(2024, 1, 31), "day") == dt.date(2024, 2, 1)
    assert period_end(dt.date(2024, 12, 1), "month") == dt.date(2025, 1, 1) and period_end(dt.date(2024, 1, 1), "month") == dt.date(2024, 2, 1)
    assert period_end(dt.date(2024, 1, 1), "year") == dt.date(2025, 1, 1)


def test_cut_off_moves_forward_only_and_retires_one_later(spark):
    lake = Lake.scratch(spark, "cutoffs")
    schema = T.StructType().add("at", "timestamp").add("location_code", "string").add("v", T.DecimalType(12, 2))
    speed = WindowedTotals(lake, "s", schema, "at", ["location_code"], "v", dt.timedelta(days=1), dt.timedelta(days=900))
    silver(spark, lake, [("1", JAN, "p", money(1), money(10))])
    gold = gold_of(lake)
    handover = Handover(lake, "h", gold, speed)
    assert not handover.hand_over() and handover.cut_off() is None
    speed.take(spark.createDataFrame([(dt.datetime(2024, m, 5), "L", money(m)) for m in (1, 2, 3)], schema), 0)

    def seen():
        return sorted((r.order_date.month, r.layer, r.n) for r in handover.view("order_date", ["location_code"], "n", "eur2", "eur").collect())

    assert seen() == [(1, "speed", 1), (2, "speed", 1), (3, "speed", 1)]
    gold.refresh()
    assert seen() == [(1, "speed", 1), (2, "speed", 1), (3, "speed", 1)]
    assert handover.hand_over() and handover.cut_off() == dt.date(2024, 2, 1) and not handover.hand_over()
    assert seen() == [(1, "batch", 1), (2, "speed", 1), (3, "speed", 1)]
    silver(spark, lake, [("2", FEB, "p", money(1), money(10))])
    gold.refresh()
    assert seen() == [(1, "batch", 1), (2, "speed", 1), (3, "speed", 1)]
    assert handover.hand_over()
    assert seen() == [(1, "batch", 1), (2, "batch", 1), (3, "speed", 1)]
    assert sorted(r.window_start.month for r in speed.windows().collect()) == [2, 3]  # January is retired, February one later
    silver(spark, lake, [("3", JAN, "p", money(1), money(10))])  # a backfill of an old period
    gold.refresh()
    assert not handover.hand_over()


def test_the_filter_of_the_speed_layer_reaches_the_scan(spark, tmp_path):
    frame = spark.createDataFrame([(JAN, 1)], "order_date date, v int")
    frame.write.parquet(str(tmp_path / "in"))

    class Fixed(Handover):
        def __init__(self):
            pass

        def cut_off(self):
            return FEB

    text = Fixed().wanted(spark.read.parquet(str(tmp_path / "in")), "order_date")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2024-02-05)" in text


def test_deliveries_cover_all_events(spark):
    events = live.dated_events(spark, "/root/testdata/sf0.001")
    found = {r["delivery"]: r["count"] for r in events.groupBy("delivery").count().collect()}
    assert set(found) == set(range(live.DELIVERIES)) and sum(found.values()) == events.count()


def test_gold_query_takes_a_load_then_corrections_then_older_exports(spark, tmp_path, monkeypatch):
    """Orders that end in 3 are corrected by 2; the first load sees recent exports without corrections, the second brings these, the third the older exports."""
    tables = {
        "region": "SELECT 0 AS r_regionkey, 'ASIA' AS r_name",
        "nation": "SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey",
        "customer": "SELECT 1L AS c_custkey, 'C' AS c_name, 0 AS c_nationkey, 'BUILDING' AS c_mktsegment, 1.0D AS c_acctbal",
        "part": "SELECT 1L AS p_partkey, 'P' AS p_name, 'B' AS p_brand, 1.0D AS p_retailprice, 1 AS p_size",
        "orders": """SELECT id AS o_orderkey, 1L AS o_custkey, CAST(day AS TIMESTAMP_NTZ) AS o_orderdate, '2-HIGH' AS o_orderpriority, 10.0D AS o_totalprice, 'F' AS o_orderstatus
            FROM VALUES (2L, '1996-03-01'), (3L, '1996-03-01'), (12L, '1999-03-01'), (13L, '1998-03-01') AS v(id, day)""",
        "lineitem": """SELECT id AS l_orderkey, 1 AS l_linenumber, 1L AS l_partkey, 1L AS l_suppkey, 1.0D AS l_quantity, 'F' AS l_linestatus, 10.0D AS l_extendedprice,
            TIMESTAMP_NTZ '1999-06-01 00:00:00' AS l_shipdate FROM VALUES 2L, 3L, 12L, 13L AS v(id)""",
    }
    for name, rows in tables.items():
        spark.sql(rows).write.parquet(f"{tmp_path}/{name}.parquet")
    seen, refresh = [], AdditiveGold.refresh

    def watched(gold):
        run = refresh(gold)
        seen.append([(float(r.total_revenue_eur), r.n_rows) for r in gold.totals().collect()])
        return run

    monkeypatch.setattr(AdditiveGold, "refresh", watched)
    found = loading.gold_incremental(spark, str(tmp_path))
    assert [(r.total_revenue_eur, r.n_rows) for r in found.collect()] == [(44.0, 4)]
    assert seen == [[(20.0, 2)], [(22.0, 2)], [(44.0, 4)]]
