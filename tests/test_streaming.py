import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import PERIOD, Lake
from stockflow.operators import merge
from stockflow.streaming import ingest

SCHEMA = T.StructType().add("id", "long").add("at", "timestamp").add("kind", "string").add("v", "long")


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


@pytest.fixture
def feed(spark, tmp_path):
    """Write batches as files, in order; each file is one micro-batch."""

    def write(*batches):
        for rows in batches:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return ingest.file_stream(spark, str(tmp_path / "in"), SCHEMA, maxFilesPerTrigger="1")

    return write


def run_windows(spark, lake, stream, checkpoint):
    totals = ingest.windowed_counts(stream, "at", ["kind"], "v", "1 hour", "2 hours")
    schema = T.StructType(
        [T.StructField("day", T.DateType()), *[f for f in totals.schema]]
    )
    with ingest.disk_state(spark):
        query = ingest.stream_upsert(
            totals.withColumn("day", F.to_date("window_start")), lake, "w", schema, ["window_start", "kind", "day"], "day",
            checkpoint, ["n_events"], output_mode="update",
        )
        ingest.run_available(query)
    return sorted((r["window_start"].hour, r["kind"], r["n_events"], r["total_value"]) for r in lake.read("w").collect())


def test_windows_grow_over_batches_and_late_events_are_left_out(spark, feed):
    lake = Lake.scratch(spark, "windows")
    stream = feed(
        [(1, at(1, 5), "a", 1), (2, at(1, 50), "a", 2)],
        [(3, at(1, 59), "a", 4), (4, at(5), "b", 8)],
        [(5, at(4, 1), "a", 16)],
        [(6, at(1, 1), "a", 32)],
    )
    got = run_windows(spark, lake, stream, f"{lake.root}-c")
    # Event 6 is more than two hours behind event 4 and its window is closed.
    assert got == [(1, "a", 3, 7), (4, "a", 1, 16), (5, "b", 1, 8)]


def test_restart_takes_only_new_files(spark, feed):
    lake = Lake.scratch(spark, "restart")
    run_windows(spark, lake, feed([(1, at(1, 5), "a", 1)]), f"{lake.root}-c")
    got = run_windows(spark, lake, feed([(2, at(1, 6), "a", 2)]), f"{lake.root}-c")
    assert got == [(1, "a", 2, 3)]


def test_stream_equals_batch(spark, feed):
    lake = Lake.scratch(spark, "parity")
    rows = [(i, at(i % 24, i % 60), "ab"[i % 2], i) for i in range(200)]
    got = run_windows(spark, lake, feed(rows), f"{lake.root}-c")
    batch = spark.createDataFrame(rows, SCHEMA).groupBy(F.hour("at"), "kind").agg(F.count("*"), F.sum("v"))
    assert got == sorted(tuple(r) for r in batch.collect())


def test_upsert_over_batches_keeps_the_newest_and_survives_a_replay(spark, feed):
    lake = Lake.scratch(spark, "upserts")
    stream = feed([(1, at(1), "a", 1), (2, at(1), "a", 1)], [(1, at(1), "a", 9), (3, at(1, day=2), "b", 1)])
    schema = T.StructType().add("id", "long").add("day", "date").add("v", "long")
    for checkpoint in ("c1", "c1", "c2"):
        query = ingest.stream_upsert(
            stream.withColumn("day", F.to_date("at")), lake, "e", schema, ["id", "day"], "day", f"{lake.root}-{checkpoint}", ["v"]
        )
        ingest.run_available(query)
        assert sorted((r["id"], r["v"]) for r in lake.read("e").drop(PERIOD).collect()) == [(1, 9), (2, 1), (3, 1)]


def test_redelivery_is_stored_once(spark, feed):
    lake = Lake.scratch(spark, "dedup")
    first = [(i, at(1, i), "a", i) for i in range(10)]
    stream = feed(first, first[5:] + [(10, at(1, 30), "a", 10)])
    with ingest.disk_state(spark):
        once = ingest.without_redelivery(stream, ["id"], "at", "1 hour")
        ingest.run_available(ingest.append_parquet(once, f"{lake.root}-out", f"{lake.root}-c"))
    assert sorted(r["id"] for r in spark.read.parquet(f"{lake.root}-out").collect()) == list(range(11))


def test_sliding_and_session_windows(spark):
    df = spark.createDataFrame([(1, at(1, 10), "a", 1), (2, at(1, 20), "a", 2), (3, at(3), "a", 4)], SCHEMA)
    sliding = ingest.windowed_counts(df, "at", ["kind"], "v", "1 hour", "1 hour", "30 minutes")
    assert {(r["window_start"].strftime("%H:%M"), r["total_value"]) for r in sliding.collect()} == {
        ("00:30", 3), ("01:00", 3), ("02:30", 4), ("03:00", 4)
    }
    sessions = ingest.session_counts(df, "at", ["kind"], "v", "15 minutes", "1 hour")
    assert {(r["window_start"].strftime("%H:%M"), r["window_end"].strftime("%H:%M"), r["n_events"]) for r in sessions.collect()} == {
        ("01:10", "01:35", 2), ("03:00", "03:15", 1)
    }


def test_error_of_a_batch_is_raised(spark, feed):
    lake = Lake.scratch(spark, "error")
    schema = T.StructType().add("id", "long").add("day", "date")
    query = ingest.stream_upsert(
        feed([(None, at(1), "a", 1)]).withColumn("day", F.to_date("at")), lake, "e", schema, ["id", "day"], "day", f"{lake.root}-c", ["id"]
    )
    with pytest.raises(Exception, match="NULL keys"):
        ingest.run_available(query)


def test_replay_of_a_large_batch_leaves_a_table_that_can_be_read(spark, feed, monkeypatch):
    """A batch that replaces all it meets is written by the stream's own session; the lake's must not look for the files that were there before."""
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    lake = Lake.scratch(spark, "replay")
    schema = T.StructType([*SCHEMA, T.StructField("day", T.DateType())])
    for run in ("first", "replay", "again"):
        stream = feed([(1, at(1), "a", 1), (2, at(2), run, 2)]) if run != "again" else feed()
        query = ingest.stream_upsert(stream.withColumn("day", F.to_date("at")), lake, "t", schema, ["id", "day"], "day", f"{lake.root}-{run}", ["kind"])
        ingest.run_available(query)
        assert sorted((r["id"], r["v"]) for r in lake.read("t").collect()) == [(1, 1), (2, 2)]


def test_disk_state_keeps_few_versions(spark, feed, tmp_path):
    """A checkpoint holds the last versions of the state, not one for every batch that has been."""
    days = range(1, 7)
    stream = feed(*[[(day, at(1, day=day), "a", 1)] for day in days])
    with ingest.disk_state(spark, 1):
        assert int(spark.conf.get("spark.sql.streaming.minBatchesToRetain")) == ingest.STATE_VERSIONS
        once = ingest.without_redelivery(stream, ["id"], "at", "1 hour")
        ingest.run_available(ingest.append_parquet(once, str(tmp_path / "out"), str(tmp_path / "c")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(days)
    commits = [f for f in (tmp_path / "c" / "commits").iterdir() if f.name.isdigit()]
    assert len(commits) <= ingest.STATE_VERSIONS + 1 < len(days)
