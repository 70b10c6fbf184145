import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.model import MOVEMENTS, SALES
from stockflow.operators import quality


def test_null_keys_are_dropped_and_counted_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None), (2, None)], "k int, d string")
    kept, counts = quality.drop_null_keys(df, ["k", "d"])
    assert [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert {r["merge_key"]: (r["rows"], r["nulls_dropped"]) for r in counts.collect()} == {"k": (4, 2), "d": (4, 2)}
    with pytest.raises(ValueError):
        quality.drop_null_keys(df, [])


def test_accepted_and_rejected_cover_the_input(spark):
    schema = T.StructType().add("k", "long").add("qty", "decimal(5,2)").add("on", "date")
    rows = [("1", "2.345", "2024-02-29"), ("x", "1", None), ("2", "12345.0", "2023-02-29"), (None, None, None)]
    checked = spark.createDataFrame(rows, "k string, qty string, on string").withColumn(
        "reasons", quality.row_reasons(schema, ["k"])
    )
    got = {tuple(r["reasons"]) for r in checked.collect()}
    assert got == {(), ("type:k",), ("type:qty", "type:on"), ("null_key:k",)}
    assert quality.rejected(checked).count() + checked.where("size(reasons) = 0").count() == len(rows)


def test_schema_diff():
    want = T.StructType().add("a", "long").add("b", "string").add("c", "date")
    have = T.StructType().add("b", "string").add("c", "string").add("d", "integer")
    assert quality.schema_diff(have, want) == {"missing": ["a"], "extra": ["d"], "mismatched": ["c"]}


def test_rules_name_each_broken_column_and_unknown_values_pass(spark):
    df = spark.createDataFrame(
        [("o1", "fulfilled", 0.5), ("o2", "lost", 1.5), ("o3", None, None), (None, "partial", 1.0)],
        "order_id string, status string, score double",
    )
    checked = quality.with_violations(
        df, {"status": SALES.domains["status"]}, {"score": (0, 1)}, {"order_id": 2}, ["order_id"]
    )
    found = {r["order_id"]: r["reasons"] for r in checked.collect()}
    assert found == {"o1": [], "o2": ["domain:status", "range:score"], "o3": [], None: ["required:order_id"]}


def test_specification_rules(spark):
    row = {f.name: None for f in MOVEMENTS.schema}
    rows = [{**row, "movement_id": "a", "movement_type": "sale"}, {**row, "movement_id": "b", "movement_type": "gift"}]
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in MOVEMENTS.schema])
    bad = quality.violations(spark.createDataFrame(rows, loose), MOVEMENTS)
    assert {r["movement_id"]: r["reasons"] for r in bad.collect()} == {
        "a": ["required:movement_date"],
        "b": ["required:movement_date", "domain:movement_type"],
    }


def test_foreign_keys_ignore_null_and_report_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, parent int")
    parent = spark.createDataFrame([(10,)], "pid int")
    assert [r["id"] for r in quality.foreign_key_violations(child, "parent", parent, "pid").collect()] == [3]


def test_defaults_fill_only_nulls_and_take_expressions(spark):
    df = spark.createDataFrame([(None, None, None), (1, False, None)], "q int, active boolean, at timestamp")
    filled = quality.apply_defaults(df, {"q": 0, "active": True, "at": F.current_timestamp()})
    rows = filled.collect()
    assert [(r["q"], r["active"]) for r in rows] == [(0, True), (1, False)] and all(r["at"] for r in rows)
    assert filled.schema["q"].dataType == T.IntegerType()
