import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockflow.lake import Lake
from stockflow.model import MOVEMENTS, SALES
from stockflow.operators.quality import check_raw
from stockflow.plans import layers
from stockflow.sources import landing

HEADER = "movement_id,movement_ts,movement_date,movement_type,product_id,sku,location_id,location_code,qty_delta,ref_order_id,ref_order_type,notes,erp_export_ts"
FEED = "inventory_movements"


def line(key="m1", day="2026-01-05", qty="-2.50", notes="ok", exported="2026-01-05T18:05:00+00:00"):
    return f"{key},{day}T09:30:00.123456+00:00,{day},sale,7,SKU-00007,1,LOC-01,{qty},o-1,sales_order,{notes},{exported}"


def drop(folder, stamp, *lines, header=HEADER, feed=FEED):
    path = folder / f"{feed}_{stamp}.csv"
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return path


def names(spark, folder, **window):
    return [e.name for e in landing.list_exports(spark, str(folder), FEED, **window)]


def read(spark, folder, **window):
    return landing.read_landing(spark, MOVEMENTS, landing.list_exports(spark, str(folder), FEED, **window))


def test_window_includes_its_first_second_and_runs_past_midnight(spark, tmp_path):
    for stamp in ("20260105_180459", "20260105_180500", "20260105_235959", "20260106_000001"):
        drop(tmp_path, stamp, line())
    assert names(spark, tmp_path, since="2026-01-05T18:05:00+00:00") == [
        f"{FEED}_20260105_180500.csv",
        f"{FEED}_20260105_235959.csv",
        f"{FEED}_20260106_000001.csv",
    ]
    assert len(names(spark, tmp_path, since="2026-01-05 18:05:00", same_day=True)) == 2
    assert len(names(spark, tmp_path, until="2026-01-05 18:05:00")) == 1
    assert len(names(spark, tmp_path, since="2026-01-05T20:05:00+02:00")) == 3


def test_other_files_and_feeds_are_left_alone(spark, tmp_path):
    drop(tmp_path, "20260105_180500", line())
    (tmp_path / f"{FEED}_20260105_180500.txt").write_text("no")
    (tmp_path / f"{FEED}_backup.csv").write_text("no")
    drop(tmp_path, "20260105_180500", line(), feed=f"{FEED}_old")
    drop(tmp_path, "20261399_990000", line())
    assert names(spark, tmp_path) == [f"{FEED}_20260105_180500.csv"]


def test_missing_feed_and_missing_folder_are_no_ops(spark, tmp_path):
    assert read(spark, tmp_path) is None
    assert read(spark, tmp_path / "absent") is None
    layers.load_bronze(Lake.scratch(spark, "none"), SALES, str(tmp_path), "2026-01-05 18:05:00")


def test_header_only_gives_nothing_and_one_row_counts(spark, tmp_path):
    drop(tmp_path, "20260105_180500")
    assert read(spark, tmp_path).count() == 0
    drop(tmp_path, "20260105_180600", line())
    row = read(spark, tmp_path).first()
    assert row["source_file"] == f"{FEED}_20260105_180600.csv"
    assert row["ingestion_date"] == dt.datetime(2026, 1, 5, 18, 6)


def test_empty_files_give_nothing(spark, tmp_path):
    (tmp_path / f"{FEED}_20260105_180400.csv").write_text("")
    assert read(spark, tmp_path) is None
    drop(tmp_path, "20260105_180500", line())
    assert read(spark, tmp_path).count() == 1


def test_each_export_is_read_by_its_own_header(spark, tmp_path):
    drop(tmp_path, "20260105_180400", line("m1"))
    first, *rest = HEADER.split(",")
    moved = line("m2").split(",")
    drop(tmp_path, "20260105_180500", ",".join([*moved[1:], moved[0]]), header=",".join([*rest, first]))
    assert sorted((r["movement_id"], r["sku"]) for r in read(spark, tmp_path).collect()) == [("m1", "SKU-00007"), ("m2", "SKU-00007")]


def test_incompatible_export_is_rejected_alone(spark, tmp_path):
    lake = Lake.scratch(spark, "header")
    drop(tmp_path, "20260105_180400", line("m1"))
    drop(tmp_path, "20260105_180500", "1,m2", "2,m3", header="extra,movement_id")
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-05 20:00:00")
    assert [r["movement_id"] for r in lake.read(layers.bronze_table(MOVEMENTS)).collect()] == ["m1"]
    rejected = lake.read(layers.rejected_table(MOVEMENTS)).collect()
    assert sorted(r["malformed_row"] for r in rejected) == ["1,m2", "2,m3"]
    assert all(len(r["reasons"]) == 1 and r["reasons"][0].startswith("schema:missing movement_ts") for r in rejected)


def test_quoted_text_survives(spark, tmp_path):
    drop(tmp_path, "20260105_180500", line(notes='"a ""b"", c"'))
    assert read(spark, tmp_path).first()["notes"] == 'a "b", c'


def test_folder_exports_read_like_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x, \"y\""), (2, None)], "id int, notes string")
    shaped = rows.select(
        *[(F.col("notes") if c == "notes" else F.lit("1")).alias(c) for c in MOVEMENTS.landing_columns], "id"
    )
    at = F.make_timestamp(F.lit(2026), F.lit(1), F.lit(5), F.lit(18), "id", F.lit(0))
    landing.export_csv(shaped, str(tmp_path), FEED, at)
    found = {(r["source_file"], r["notes"]) for r in read(spark, tmp_path).collect()}
    assert found == {(f"{FEED}_20260105_180100.csv", 'x, "y"'), (f"{FEED}_20260105_180200.csv", None)}


def test_nothing_is_exported_without_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "movement_id string")
    landing.export_csv(empty, str(tmp_path / "out"), FEED, F.current_timestamp())
    assert names(spark, tmp_path / "out") == []


def test_columns_missing_extra_and_reordered(spark, tmp_path):
    drop(tmp_path, "20260105_180500", "1,m1", header="extra,movement_id")
    assert read(spark, tmp_path).first()["schema_fault"].startswith("schema:missing movement_ts")
    other = tmp_path / "other"
    other.mkdir()
    drop(other, "20260105_180500", "9," + line(), header="extra," + HEADER)
    row = read(spark, other).first()
    assert row["movement_id"] == "m1" and "extra" not in row.asDict()


def test_landing_again_replaces_only_its_partition(spark, tmp_path):
    lake = Lake.scratch(spark, "raw")
    drop(tmp_path, "20260105_180500", line("a"))
    drop(tmp_path, "20260106_180500", line("b"), line("c"))
    landing.write_raw(lake, MOVEMENTS, check_raw(read(spark, tmp_path), MOVEMENTS))
    drop(tmp_path, "20260106_180500", line("d"))
    landing.write_raw(lake, MOVEMENTS, check_raw(read(spark, tmp_path, since="2026-01-06"), MOVEMENTS))
    assert {r[0] for r in landing.read_raw(lake, MOVEMENTS).select("movement_id").collect()} == {"a", "d"}
    assert [r[0] for r in landing.read_raw(lake, MOVEMENTS, "2026-01-06").select("movement_id").collect()] == ["d"]
    assert landing.latest_export_time(lake, MOVEMENTS) == dt.datetime(2026, 1, 6, 18, 5)
    assert [r[0] for r in landing.read_latest(lake, MOVEMENTS).select("movement_id").collect()] == ["d"]


def faulty(folder):
    drop(
        folder,
        "20260105_180500",
        line("m1"),
        line(""),
        line("", day=""),
        line("m4", qty="x"),
        line("m5") + ",surplus",
        line("m6", day="2026-02-30"),
    )


def test_bronze_accepts_rejects_and_monitors(spark, tmp_path):
    lake = Lake.scratch(spark, "bronze")
    faulty(tmp_path)
    for moment in ("2026-01-05 19:00:00", "2026-01-05 20:00:00"):
        layers.load_bronze(lake, MOVEMENTS, str(tmp_path), moment, "2026-01-05 18:05:00")
    (row,) = lake.read(layers.bronze_table(MOVEMENTS)).collect()
    assert (row["movement_id"], row["qty_delta"], row["source_system"]) == ("m1", -2.5, "ERP")
    assert row["movement_ts"] == dt.datetime(2026, 1, 5, 9, 30, 0, 123456)
    assert row["processed_date"] == dt.datetime(2026, 1, 5, 20, 0)
    rejected = sorted(tuple(r["reasons"]) for r in lake.read(layers.rejected_table(MOVEMENTS)).collect())
    assert rejected == sorted(
        [
            ("null_key:movement_id",),
            ("null_key:movement_id", "null_key:movement_date"),
            ("type:qty_delta",),
            ("malformed_row",),
            ("type:movement_ts", "type:movement_date"),
        ]
    )
    monitored = lake.read(layers.MONITORING_TABLE).distinct().collect()
    assert {(r["merge_key"], r["rows"], r["nulls_dropped"], r["incompatible"]) for r in monitored} == {
        ("movement_id", 6, 2, 3),
        ("movement_date", 6, 1, 3),
    }


def test_corrected_export_clears_its_rejected_rows(spark, tmp_path):
    lake = Lake.scratch(spark, "corrected")
    faulty(tmp_path)
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-05 19:00:00")
    drop(tmp_path, "20260105_180500", line("m1", qty="4"))
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-05 20:00:00")
    assert lake.read(layers.rejected_table(MOVEMENTS)).isEmpty()
    assert [r["qty_delta"] for r in lake.read(layers.bronze_table(MOVEMENTS)).collect()] == [4.0]


def test_later_export_wins_and_silver_catches_up(spark, tmp_path):
    lake = Lake.scratch(spark, "silver")
    drop(tmp_path, "20260105_180500", line("m1", qty="1"), line("m2", qty="5.555"))
    drop(tmp_path, "20260106_180500", line("m1", qty="2", exported="2026-01-06T18:05:00+00:00"))
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-06 19:00:00")
    layers.promote_silver(lake, MOVEMENTS)
    drop(tmp_path, "20260107_180500", line("m3", day="2026-01-07"))
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-07 19:00:00", "2026-01-07")
    drop(tmp_path, "20260108_180500", line("m4", day="2026-01-08"))
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-08 19:00:00", "2026-01-08")
    layers.promote_silver(lake, MOVEMENTS)
    silver = {r["movement_id"]: r["qty_delta"] for r in lake.read(layers.silver_table(MOVEMENTS)).collect()}
    assert {k: str(v) for k, v in silver.items()} == {"m1": "2.00", "m2": "5.56", "m3": "-2.50", "m4": "-2.50"}
    assert lake.read(layers.silver_table(MOVEMENTS)).schema["qty_delta"].dataType.simpleString() == "decimal(12,2)"


def test_silver_can_take_one_day(spark, tmp_path):
    lake = Lake.scratch(spark, "day")
    for day in ("05", "06"):
        drop(tmp_path, f"202601{day}_180500", line(f"m{day}", day=f"2026-01-{day}"))
        layers.load_bronze(lake, MOVEMENTS, str(tmp_path), f"2026-01-{day} 19:00:00", f"2026-01-{day}")
    layers.promote_silver(lake, MOVEMENTS, day="2026-01-05")
    assert [r["movement_id"] for r in lake.read(layers.silver_table(MOVEMENTS)).collect()] == ["m05"]


def test_key_repeated_in_one_export_is_rejected_and_accounted_for(spark, tmp_path):
    lake = Lake.scratch(spark, "repeat")
    drop(tmp_path, "20260105_180500", line("m1", qty="1"), line("m1", qty="2"), line("m2"), line("m3", qty="99999999999"), line("m4", qty="NaN"), line("m5", day="0001-01-01"))
    drop(tmp_path, "20260106_180500", line("m2", qty="7", exported="2026-01-06T18:05:00+00:00"))
    layers.load_bronze(lake, MOVEMENTS, str(tmp_path), "2026-01-06 19:00:00")
    layers.promote_silver(lake, MOVEMENTS)
    rejected = sorted((r["movement_id"], r["reasons"][0]) for r in lake.read(layers.rejected_table(MOVEMENTS)).collect())
    assert rejected == [("m1", "duplicate_key"), ("m1", "duplicate_key"), ("m3", "type:qty_delta"), ("m4", "type:qty_delta"), ("m5", "range:movement_date")]
    assert [(r["movement_id"], float(r["qty_delta"])) for r in lake.read(layers.silver_table(MOVEMENTS)).collect()] == [("m2", 7.0)]
    accounts = {r["source_file"][-19:-4]: (r["landed"], r["accepted"], r["rejected"], r["superseded"]) for r in lake.read(layers.ACCOUNTING_TABLE).collect()}
    assert accounts == {"20260105_180500": (6, 0, 5, 1), "20260106_180500": (1, 1, 0, 0)}


def test_silver_takes_loads_of_an_equal_and_of_an_older_moment(spark, tmp_path):
    lake = Lake.scratch(spark, "moments")
    for k, moment in (("05", "2026-01-09 19:00:00"), ("06", "2026-01-09 19:00:00"), ("07", "2026-01-01 00:00:00")):
        drop(tmp_path, f"202601{k}_180500", line(f"m{k}", day=f"2026-01-{k}"))
        layers.load_bronze(lake, MOVEMENTS, str(tmp_path), moment, f"2026-01-{k}")
        layers.promote_silver(lake, MOVEMENTS)
    assert sorted(r["movement_id"] for r in lake.read(layers.silver_table(MOVEMENTS)).collect()) == ["m05", "m06", "m07"]
    assert lake.read(layers.promoted_table(MOVEMENTS)).count() == 3
