"""Streaming over the events table. Each query runs to the end of the available input and returns its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import PERIOD, Lake
from stockflow.plans.serving import serving_view as merge_layers
from stockflow.queries.common import as_doubles, as_plain_time, grain_for, state_partitions
from stockflow.sources.domain import Domain
from stockflow.streaming import ingest

DELAY = "1 day"
CUT_OFF = "2024-01-16 00:00:00"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
WINDOW_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("window_date", T.DateType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("n_events", T.LongType()),
        T.StructField("total_value", T.DecimalType(22, 2)),
    ]
)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain(spark, sf_dir)
    # The trailing star lets the path be a single file or a folder of files.
    stream = ingest.file_stream(spark, d.path("events") + "*", d.table("events").schema)
    return stream.withColumn("at", F.col("ts").cast("timestamp"))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and, delivered with them, a correction of every error event: its value is withdrawn."""
    lake = Lake.scratch(spark, "stream-upsert")
    grain = grain_for(Domain(spark, sf_dir), "events", "ts")
    events = event_stream(spark, sf_dir).withColumns({"event_date": F.to_date("ts"), "delivery": F.lit(1)})
    again = event_stream(spark, sf_dir).withColumns({"event_date": F.to_date("ts"), "delivery": F.lit(2)})
    corrected = again.where(F.col("event_type") == "error").withColumn("value", F.lit(None).cast("double"))
    for run in ("first", "replay"):
        query = ingest.stream_upsert(
            events.unionByName(corrected),
            lake,
            "events",
            EVENT_SCHEMA,
            ["event_id", "event_date"],
            "event_date",
            f"{lake.root}-checkpoint-{run}",
            ["delivery"],
            grain,
        )
        ingest.run_available(query)
    return lake.read("events").drop(PERIOD)


def windowed_lake(spark: SparkSession, sf_dir: str, label: str, since: str | None = None) -> Lake:
    """Daily totals per type, kept current by each micro-batch.

    In update mode each batch emits the windows it changed; merging them by window keeps the result whole at any
    moment, where append mode would hold back the windows that may still change. ``since`` filters at the stream's source.
    """
    lake = Lake.scratch(spark, label)
    events = event_stream(spark, sf_dir)
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    events = events.withColumn("value", F.col("value").cast("decimal(12,2)"))
    totals = ingest.windowed_counts(events, "at", ["event_type"], "value", "1 day", DELAY)
    dated = totals.withColumn("window_date", F.to_date("window_start"))
    with ingest.disk_state(spark, state_partitions(Domain(spark, sf_dir), "events")):
        query = ingest.stream_upsert(
            dated,
            lake,
            "windows",
            WINDOW_SCHEMA,
            ["window_start", "event_type", "window_date"],
            "window_date",
            f"{lake.root}-checkpoint",
            ["n_events"],
            grain="year",  # one row per window and type: years of them are small
            output_mode="update",
        )
        ingest.run_available(query)
    return lake


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windowed_lake(spark, sf_dir, "tumbling").read("windows").drop(PERIOD, "window_date")
    return as_doubles(as_plain_time(rows, "window_start", "window_end"), "total_value")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lots of ten days in three batches; each lot brings the last half day of the lot before once more, and some of its own events twice. All are stored once."""
    lake = Lake.scratch(spark, "dedup")
    events = Domain(spark, sf_dir).table("events")
    folder, path = f"{lake.root}-in", f"{lake.root}-events"
    day = F.datediff("ts", F.lit("2024-01-01").cast("date"))
    for lot in range(3):
        own = events.where(F.least(F.floor(day / 10), F.lit(2)) == lot)
        begin = F.lit(f"2024-01-{10 * lot + 1:02d} 00:00:00").cast("timestamp_ntz")
        before = events.where((F.col("ts") < begin) & (F.col("ts") >= begin - F.expr("INTERVAL 12 HOURS")))
        own.unionByName(before).unionByName(own.where("event_id % 3 = 0")).write.mode("append").parquet(folder)
        arriving = ingest.file_stream(spark, folder, events.schema).withColumn("at", F.col("ts").cast("timestamp"))
        with ingest.disk_state(spark, state_partitions(Domain(spark, sf_dir), "events")):
            once = ingest.without_redelivery(arriving, ["event_id"], "at", DELAY)
            ingest.run_available(ingest.append_parquet(once.drop("at"), path, f"{lake.root}-checkpoint"))
    return spark.read.parquet(path)


def serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days before the cut-off from the batch layer, later days from the stream."""
    speed = windowed_lake(spark, sf_dir, "serving", CUT_OFF).read("windows").drop(PERIOD, "window_date")
    speed = as_plain_time(speed, "window_start", "window_end")
    start = F.date_trunc("day", "ts").cast("timestamp_ntz")
    batch = (
        Domain(spark, sf_dir)
        .table("events")
        .where(F.col("ts") < F.lit(CUT_OFF).cast("timestamp_ntz"))
        .groupBy(start.alias("window_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(12,2)")).alias("total_value"))
        .withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 DAY"))
        .select("window_start", "window_end", "event_type", "n_events", "total_value")
    )
    return as_doubles(merge_layers(batch, speed, "window_start", CUT_OFF), "total_value")


_DAYS = """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
    event_type, COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2, 3"""

QUERIES = {
    "stream_upsert": (
        stream_upsert,
        """SELECT event_id, CAST(ts AS DATE) AS event_date, ts, user_id, event_type,
    CASE WHEN event_type <> 'error' THEN value END AS value FROM events""",
    ),
    "stream_tumbling": (stream_tumbling, _DAYS),
    "stream_dedup": (stream_dedup, "SELECT * FROM events"),
    "serving_view": (
        serving_view,
        f"""SELECT *, CASE WHEN window_start < TIMESTAMP '{CUT_OFF}' THEN 'batch' ELSE 'speed' END AS layer
FROM ({_DAYS})""",
    ),
}
