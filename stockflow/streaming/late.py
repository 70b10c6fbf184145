"""Windowed totals of a stream that lose no event.

A stateful window drops what comes after its watermark without a trace. Here each micro-batch is split by the watermark it runs with (the latest event
time of the batches before it, less the delay): events of windows that are still open are added up, events behind it go to a table of late
events, both in the same batch and under the same ledger, so on time + late = landed. A batch step later folds the late events in.

Totals are additive, so a batch adds a *part*: its own totals by window, in a partition of its own. A part that is written twice is the same part. The windows
are the sum of all parts; ``settle`` sums them into one, and a reader sees either the old parts or the new one, never both.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from stockflow.lake import Lake
from stockflow.streaming.ledger import BATCH, BEGUN, DONE, BatchLedger, Entry

PART = "part"
BASE, LATE = "base", "late"
SETTLED = T.StructType([T.StructField("version", T.LongType()), T.StructField(PART, T.StringType())])


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


class WindowedTotals:
    """Count and sum per tumbling event-time window and key, kept as parts in a lake.

    ``name`` is the stream's name and the prefix of its tables: ``<name>_parts``, ``<name>_late``, ``<name>_settled``. Windows are counted from 1970, as Spark
    counts them, and an event is late if its window ends at or before the watermark. Events without time belong to no window: they are kept
    with the late ones and stay there. A NULL value counts as an event and adds nothing.
    """

    def __init__(self, lake: Lake, name: str, schema: T.StructType, time_column: str, keys: Sequence[str], value: str, width: timedelta, delay: timedelta):
        self.lake, self.name, self.keys, self.value, self.delay_us = lake, name, list(keys), value, micros(delay)
        self.columns = schema.fieldNames()
        at, width_us = F.unix_micros(F.col(time_column).cast("timestamp")), F.lit(micros(width))
        self.at, self.start_us = at, at - F.pmod(at, width_us)
        self.end_us = self.start_us + width_us
        amount = schema[value].dataType
        total = T.DecimalType(38, amount.scale) if isinstance(amount, T.DecimalType) else T.DoubleType() if isinstance(amount, T.FractionalType) else T.LongType()
        spans = [T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType())]
        sums = [T.StructField("n_events", T.LongType()), T.StructField("total_value", total)]
        self.schema = T.StructType([*spans, *[schema[k] for k in keys], *sums, T.StructField(PART, T.StringType())])
        lake.ensure(self.late_table, T.StructType([*schema, T.StructField(BATCH, T.StringType())]), BATCH)
        lake.ensure(self.parts_table, self.schema, PART)
        lake.ensure(self.settled_table, SETTLED)

    @property
    def parts_table(self) -> str:
        return f"{self.name}_parts"

    @property
    def late_table(self) -> str:
        return f"{self.name}_late"

    @property
    def settled_table(self) -> str:
        return f"{self.name}_settled"

    def parts_of(self, events: DataFrame, part: Column) -> DataFrame:
        """One additive row for each window, key and part of the events."""
        windows = [F.timestamp_micros(self.start_us).alias("window_start"), F.timestamp_micros(self.end_us).alias("window_end")]
        total = F.sum(self.value).cast(self.schema["total_value"].dataType)
        return events.groupBy(*windows, *self.keys, part.alias(PART)).agg(F.count(F.lit(1)).alias("n_events"), total.alias("total_value"))

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: late events into their table, the others as a part of the windows."""
        ledger = BatchLedger(self.lake, self.name)
        entry = ledger.entry(batch_id)
        if entry and entry.state == DONE:
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # it is read three times
        try:
            before = ledger.newest_before(batch_id)
            if entry is None:
                entry = Entry(BEGUN, None if before is None else before - self.delay_us)
                ledger.note(batch_id, entry)
            closed = F.lit(False) if entry.watermark_us is None else self.end_us <= F.lit(entry.watermark_us)
            late = self.at.isNull() | closed
            newest, landed, n_late = batch.agg(F.max(self.at), F.count(F.lit(1)), F.count_if(late)).first()
            label = ledger.label(batch_id)
            self.lake.replace_partitions(self.late_table, batch.where(late).select(*self.columns, label.alias(BATCH)), BATCH, rebalance=False)
            self.lake.replace_partitions(self.parts_table, self.parts_of(batch.where(~late), label), PART, rebalance=False)
            known = [t for t in (before, newest) if t is not None]
            ledger.note(batch_id, Entry(DONE, entry.watermark_us, max(known, default=None), landed, landed - n_late, n_late))
        finally:
            batch.unpersist()

    def stream(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            events.writeStream.foreachBatch(self.take)
            .queryName(f"{self.name}_{uuid.uuid4().hex[:8]}")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def labels(self, table: str, column: str) -> set[str]:
        """Partition names from the catalog: as many as there were batches since parts were last settled."""
        return {row[0] for row in self.lake.partitions(table, column).toLocalIterator()}

    def fold_late(self) -> int:
        """Add the late events of every batch that has not been folded yet, as parts; the number of batches folded.

        A batch's late events become one part, so what is folded shows by the part that is there, or has been settled.
        """
        wanted = {f"{LATE}-{b}": b for b in self.labels(self.late_table, BATCH)}
        folded = self.labels(self.parts_table, PART) | self.settled(wanted)
        waiting = sorted(b for part, b in wanted.items() if part not in folded)
        if waiting:
            late = self.lake.read(self.late_table).where(F.col(BATCH).isin(waiting) & self.at.isNotNull())
            self.lake.replace_partitions(self.parts_table, self.parts_of(late, F.concat(F.lit(f"{LATE}-"), BATCH)), PART, rebalance=False)
        return len(waiting)

    def version(self) -> int:
        return self.lake.read(self.settled_table).agg(F.max("version")).first()[0] or 0

    def live(self, version: int) -> list[str]:
        """The parts that make up the windows: the settled one of this version, and those that no version has settled."""
        there, base = self.labels(self.parts_table, PART), f"{BASE}-{version}"
        settled = self.settled(there)
        return sorted(p for p in there if p == base or not (p.startswith(f"{BASE}-") or p in settled))

    def settled(self, parts: Iterable[str]) -> set[str]:
        """Those of the named parts that have been summed into a settled one."""
        return {row[PART] for row in self.lake.read(self.settled_table).where(F.col(PART).isin(list(parts))).toLocalIterator()}

    def settle(self, since: datetime | None = None) -> None:
        """Sum all parts into one, without the windows that begin before ``since`` (UTC): those are retired, and all at once for readers.

        The notes of what the new part holds are one small append, and make it count; what it replaces is dropped after that.

        A run that breaks off before leaves a part that nobody reads, one that breaks off after leaves parts that nobody reads.
        """
        version = self.version()
        live = self.live(version)
        if not live:
            return
        base = f"{BASE}-{version + 1}"
        summed = self.summed(live).withColumn(PART, F.lit(base))
        kept = summed if since is None else summed.where(F.col("window_start") >= F.lit(since.isoformat(" ")).cast("timestamp"))
        self.lake.replace_partitions(self.parts_table, kept, PART)
        notes = [(version + 1, part) for part in live]
        self.lake.append(self.settled_table, self.lake.spark.createDataFrame(notes, SETTLED).coalesce(1))
        self.lake.drop_labels(self.parts_table, PART, sorted(self.labels(self.parts_table, PART) - set(self.live(version + 1))))

    def summed(self, parts: Sequence[str]) -> DataFrame:
        own = self.lake.read(self.parts_table).where(F.col(PART).isin(list(parts)))
        total = F.sum("total_value").cast(self.schema["total_value"].dataType)
        return own.groupBy("window_start", "window_end", *self.keys).agg(F.sum("n_events").alias("n_events"), total.alias("total_value"))

    def windows(self) -> DataFrame:
        """The totals of all windows as of now. The parts are named in the plan, so it stays the same while others are added."""
        return self.summed(self.live(self.version()))
