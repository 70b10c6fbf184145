import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import types as T

from stockflow.lake import PERIOD, Lake, pick_grain
from stockflow.operators import merge

SCHEMA = T.StructType().add("id", "long").add("day", "date").add("v", "string").add("seq", "long")
KEYS = ["id", "day"]
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 1)


def put(lake, rows, on_duplicate="error", latest_by=("seq",), table="t", grain="day"):
    source = lake.spark.createDataFrame(rows, "extra string, v string, id long, day date, seq long")
    merge.upsert(lake, table, SCHEMA, source, KEYS, "day", on_duplicate, latest_by, grain)


def row(i, day, v="a", seq=1):
    return ("x", v, i, day, seq)


def content(lake, table="t"):
    return sorted((r["id"], r["day"], r["v"]) for r in lake.read(table).collect())


@pytest.fixture
def lake(spark):
    return Lake.scratch(spark, "merge-test")


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_match_overwrites_even_with_null_and_others_stay(lake, grain):
    put(lake, [row(1, D1), row(2, D1), row(1, D2), row(3, D3)], grain=grain)
    put(lake, [row(1, D1, None), row(4, D1, "new")], grain=grain)
    assert content(lake)[0] == (1, D1, None)
    assert set(content(lake)) == {(1, D1, None), (2, D1, "a"), (1, D2, "a"), (3, D3, "a"), (4, D1, "new")}
    assert lake.read("t").columns == ["id", "day", "v", "seq", PERIOD]


def test_rerun_and_order_of_disjoint_batches_change_nothing(lake):
    first, second = [row(1, D1), row(2, D2)], [row(3, D1, "b"), row(4, D3, "b")]
    for batch in (first, second, second, first):
        put(lake, batch)
    for batch in (second, first):
        put(lake, batch, table="u")
    assert content(lake) == content(lake, "u") and len(content(lake)) == 4


def test_untouched_partitions_keep_their_files(lake):
    put(lake, [row(1, D1), row(2, D2)])
    before = {f for f in lake.read("t").where(f"{PERIOD} = '2024-01-02'").inputFiles()}
    put(lake, [row(1, D1, "b")])
    assert {f for f in lake.read("t").where(f"{PERIOD} = '2024-01-02'").inputFiles()} == before
    assert len(list(Path(lake.root, "t").glob(f"{PERIOD}=2024-01-01/*.parquet"))) == 1


def test_repeated_key_is_refused_or_resolved(lake):
    batch = [row(1, D1, "old", 1), row(1, D1, "new", 2), row(1, D1, "none", None)]
    with pytest.raises(merge.DuplicateKeys):
        put(lake, batch)
    put(lake, batch, "latest")
    assert content(lake) == [(1, D1, "new")]


def test_insert_mode_keeps_repeats_until_they_match(lake):
    batch = [row(1, D1, "a"), row(1, D1, "b")]
    put(lake, batch, "insert")
    assert len(content(lake)) == 2
    with pytest.raises(merge.AmbiguousMerge):
        put(lake, batch, "insert")
    put(lake, [row(2, D1), row(2, D1)], "insert")
    put(lake, [row(1, D1, "one")], "insert")
    assert [c for c in content(lake) if c[0] == 1] == [(1, D1, "one")]


def test_null_keys_and_bad_arguments_are_refused(lake):
    with pytest.raises(merge.NullKeys):
        put(lake, [row(None, D1)])
    with pytest.raises(merge.NullKeys):
        put(lake, [row(1, None)])
    with pytest.raises(ValueError):
        put(lake, [row(1, D1)], "guess")


def test_empty_batch_makes_an_empty_table(lake):
    put(lake, [])
    assert content(lake) == []


def test_latest_needs_an_order_and_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS seq")
    assert merge.latest_per_key(df, [], ["seq"]).first() == (0, 999)
    with pytest.raises(ValueError):
        merge.latest_per_key(df, ["k"], [])
    best = merge.latest_per_key(df, ["k"], ["seq"])
    assert {tuple(r) for r in best.collect()} == {(0, 999), (1, 997), (2, 998)} and best.columns == ["k", "seq"]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_grain_follows_size():
    tb = 10**12
    assert pick_grain(100 * tb, 2500) == "day"
    assert pick_grain(tb // 50, 2500) == "month"
    assert pick_grain(10**7, 2500) == "year"
    assert pick_grain(0, 0) == "year"
