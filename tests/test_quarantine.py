"""Rules and references in the load: rows that wait, and leave when their parents come."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import Lake
from stockflow.model import MOVEMENTS, SALES
from stockflow.operators import merge, quality
from stockflow.plans import gold_tables, layers, views
from stockflow.plans.job import run_batch
from stockflow.queries import loading
from stockflow.sources import landing
from stockflow.sources.domain import Domain
from tests.test_live import sales_row

SF_DIR = "/root/testdata/sf0.001"
TEXT = T.StructType([T.StructField(c, T.StringType()) for c in SALES.landing_columns])


def parents(spark, products):
    return {"products": spark.createDataFrame([(p,) for p in products], "product_id string"), "locations": spark.createDataFrame([(1,), (1,)], "location_id long")}


def with_product(order, product, **row):
    own = list(sales_row(order, **row))
    own[TEXT.fieldNames().index("product_id")] = product
    return tuple(own)


def load(spark, lake, rows, stamp, known, moment="2024-03-01 00:00:00"):
    landing.export_csv(spark.createDataFrame(rows, TEXT), f"{lake.root}-in", SALES.name, F.lit(stamp).cast("timestamp"))
    layers.load_bronze(lake, SALES, f"{lake.root}-in", moment, stamp, grain="month")
    layers.promote_silver(lake, SALES, grain="month", parents=known)


def placed(lake):
    return sorted((r.order_id, r.place) for r in loading.where_rows_are(lake).collect())


@pytest.fixture
def lake(spark):
    lake = Lake.scratch(spark, "waiting")
    rows = [with_product("1", "a"), with_product("2", "b"), with_product("3", "c", date="2024-02-01"), with_product("4", None)]
    load(spark, lake, rows, "2024-02-01 18:00:00", parents(spark, ["a"]))
    return lake


WAIT = "quarantine unknown:product_id"


def test_rows_wait_and_are_released_once(spark, lake):
    assert placed(lake) == [("1", "silver"), ("2", WAIT), ("3", WAIT), ("4", "rejected null_key:product_id")]
    assert layers.release_quarantine(lake, SALES, parents(spark, ["a"]), "month") == 0
    assert layers.release_quarantine(lake, SALES, parents(spark, ["a", "b"]), "month") == 1
    assert placed(lake) == [("1", "silver"), ("2", "silver"), ("3", WAIT), ("4", "rejected null_key:product_id")]
    assert layers.release_quarantine(lake, SALES, parents(spark, ["a", "b"]), "month") == 0
    assert layers.release_quarantine(lake, SALES, parents(spark, ["c"]), "month") == 1
    assert lake.read(layers.quarantine_table(SALES)).count() == 0


def test_a_corrected_row_leaves_the_quarantine(spark, lake):
    load(spark, lake, [with_product("9", "zz"), with_product("2", "a", export="2024-02-02 18:00:00")], "2024-02-02 18:00:00", parents(spark, ["a"]))
    # Order 2 with product a is another key; product b of it still waits, and so does order 9.
    assert [p for p in placed(lake) if p[1] == WAIT] == [("2", WAIT), ("3", WAIT), ("9", WAIT)]
    load(spark, lake, [with_product("9", "zz", export="2024-02-03 18:00:00")], "2024-02-03 18:00:00", parents(spark, ["a", "b", "zz"]))
    assert [p for p in placed(lake) if p[1] == WAIT] == [("3", WAIT)]  # January was promoted anew, February was not


def test_a_broken_release_is_done_again(spark, lake, monkeypatch):
    known, plain, calls = parents(spark, ["a", "b"]), Lake.replace_partitions, [0]

    def failing(*args, **kwargs):
        calls[0] += 1
        if calls[0] == 2:  # Silver has the row, the quarantine still has it too
            raise OSError("gone")
        return plain(*args, **kwargs)

    with monkeypatch.context() as broken:
        broken.setattr(Lake, "replace_partitions", failing)
        with pytest.raises(OSError):
            layers.release_quarantine(lake, SALES, known, "month")
    assert sorted(p for _, p in placed(lake)).count("silver") == 2 and lake.read(layers.quarantine_table(SALES)).count() == 2
    assert layers.release_quarantine(lake, SALES, known, "month") == 1
    assert placed(lake) == [("1", "silver"), ("2", "silver"), ("3", WAIT), ("4", "rejected null_key:product_id")]


def test_gold_takes_released_rows(spark, lake):
    gold = gold_tables.gold_sales(lake, 2)
    gold.refresh()
    assert {r.product_id for r in gold.totals().collect()} == {"a"}
    layers.release_quarantine(lake, SALES, parents(spark, ["a", "b", "c"]), "month")
    gold.refresh()
    assert {r.product_id for r in gold.totals().collect()} == {"a", "b", "c"}


def test_rules_of_the_specification_are_reasons(spark):
    spec = dataclasses.replace(SALES, ranges={"qty_ordered": (0, 10)})
    good = dict(zip(TEXT.fieldNames(), sales_row("1"), strict=True))
    rows = [good, {**good, "status": "x"}, {**good, "qty_ordered": "11"}, {**good, "customer_code": "C" * 11}, {**good, "status": None}, {**good, "status": "x", "qty_ordered": "abc"}]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], TEXT).withColumns({"malformed_row": F.lit(None).cast("string"), "schema_fault": F.lit(None).cast("string")})
    assert [r.reasons for r in quality.check_raw(frame, spec).collect()] == [[], ["domain:status"], ["range:qty_ordered"], ["length:customer_code"], [], ["type:qty_ordered", "domain:status"]]


def test_references_repeat_no_row_and_null_passes(spark):
    child = spark.createDataFrame([("1", "a", "1"), ("2", None, "1"), ("3", "b", "2")], "order_id string, product_id string, location_id string")
    found = quality.with_unknown(child, SALES, parents(spark, ["a", "a"]))
    assert sorted((r.order_id, tuple(r.reasons)) for r in found.collect()) == [("1", ()), ("2", ()), ("3", ("unknown:location_id", "unknown:product_id"))]
    assert found.columns == [*child.columns, "reasons"]


def test_latest_of_all_rows(spark):
    rows = spark.createDataFrame([(1, 5), (2, 9), (3, None)], "k int, v int")
    found = merge.latest_per_key(rows, [], ["v"])
    assert [r.k for r in found.collect()] == [2]
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def drifted(spark, folder, name, header, lines):
    path = folder / f"{SALES.name}_20240201_180000.csv"
    path.mkdir(exist_ok=True)
    (path / name).write_text(",".join(header) + "\n" + "\n".join(lines) + "\n")
    return str(folder)


def test_part_files_by_their_own_headers(spark, tmp_path):
    names = TEXT.fieldNames()
    row = dict(zip(names, sales_row("1"), strict=True))
    turned = [*reversed(names), "extra col"]
    drifted(spark, tmp_path, "a.csv", names, [",".join(row[c] for c in names)])
    drifted(spark, tmp_path, "b.csv", turned, [",".join({**row, "order_id": "2", "extra col": '"x, y"'}[c] for c in turned), "too,short"])
    drifted(spark, tmp_path, "c.csv", names[1:], ["whatever"])
    drifted(spark, tmp_path, "d.csv", [*names, "sku"], ["twice"])
    drifted(spark, tmp_path, "e.csv", ["id" if c == "order_id" else c for c in names], [",".join({**row, "order_id": "3"}[c] for c in names)])
    (tmp_path / f"{SALES.name}_20240201_180000.csv" / "_SUCCESS").write_text("")
    (tmp_path / f"{SALES.name}_20240201_180000.csv" / "empty.csv").write_text("")
    spec = dataclasses.replace(SALES, aliases={"id": "order_id"})
    rows = landing.read_landing(spark, spec, landing.list_exports(spark, str(tmp_path), SALES.name)).collect()
    assert {r.order_id for r in rows if r.order_id and not r.malformed_row} == {"1", "2", "3"}
    assert [r.rescued for r in rows if r.order_id == "2"] == [{"extra col": "x, y"}]
    assert sorted(r.schema_fault for r in rows if r.schema_fault) == ["schema:missing order_id", "schema:repeated sku"]
    assert [r.malformed_row for r in rows if r.malformed_row and not r.schema_fault] == ["too,short"]
    assert {r.source_file for r in rows} == {f"{SALES.name}_20240201_180000.csv"}


def test_a_note_with_a_line_break_comes_back_whole(spark, tmp_path):
    names = MOVEMENTS.landing_columns
    row = {c: "1" for c in names} | {"notes": 'two\nlines, "quoted"', "movement_date": "2024-01-01"}
    frame = spark.createDataFrame([tuple(row[c] for c in names)] * 2, T.StructType([T.StructField(c, T.StringType()) for c in names]))
    landing.export_csv(frame, str(tmp_path), MOVEMENTS.name, F.lit("2024-01-01 18:00:00").cast("timestamp"))
    back = landing.read_landing(spark, MOVEMENTS, landing.list_exports(spark, str(tmp_path), MOVEMENTS.name)).collect()
    assert [r.notes for r in back] == [row["notes"]] * 2 and not any(r.malformed_row for r in back)


def test_the_job_writes_gold_and_its_views(spark):
    lake, landing_dir = loading.export_sales(spark, SF_DIR, "jobgold")
    run_batch(lake, landing_dir, loading.FIRST_RUN, grain="year", buckets=2)
    assert lake.read("vw_gold_daily_sales").count() == lake.read("gold_sales_daily").count() > 0
    assert lake.read("vw_gold_product_sales").agg(F.sum("n_lines")).first()[0] == lake.read(layers.silver_table(SALES)).count()
    assert not lake.exists("vw_gold_stock")  # there were no movements
    before = lake.read("gold_sales_total").inputFiles()
    run_batch(lake, landing_dir, loading.SECOND_RUN, grain="year", buckets=2)
    assert lake.read("gold_sales_total").inputFiles() == before  # the same rows again make no difference


def test_views_show_what_the_tables_hold(spark):
    lake, d = Lake.scratch(spark, "views"), Domain(spark, SF_DIR)
    assert views.register(lake, views.VIEWS) == []
    views.store_operational(lake, {"purchase_orders": d.purchase_lines(), "suppliers": d.suppliers()})
    assert views.register(lake, views.VIEWS) == [views.SUPPLIER_PERFORMANCE]
    n = lake.read(views.SUPPLIER_PERFORMANCE).count()
    views.store_operational(lake, {"purchase_orders": d.purchase_lines().where("supplier_id % 2 = 0")})
    assert 0 < lake.read(views.SUPPLIER_PERFORMANCE).count() < n
    with pytest.raises(ValueError):
        views.store_operational(lake, {"other": d.suppliers()})


def test_dates_of_the_fixture():
    assert dt.date.fromisoformat(sales_row("1")[2]) == dt.date(2024, 1, 1)
