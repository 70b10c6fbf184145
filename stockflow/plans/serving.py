"""One view over the batch layer and the speed layer, and the hand-over from one to the other."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import PERIOD, Lake
from stockflow.plans.gold_tables import DONE, AdditiveGold
from stockflow.streaming.late import WindowedTotals

CUT_OFFS = T.StructType([T.StructField("version", T.LongType()), T.StructField("cut_off", T.DateType())])


def serving_view(batch: DataFrame, speed: DataFrame, time_column: str, cut_off: datetime | str) -> DataFrame:
    """Batch rows before the cut-off, speed rows from it on. The filters reach both scans."""
    at = F.lit(cut_off).cast(batch.schema[time_column].dataType)
    return (
        batch.where(F.col(time_column) < at)
        .withColumn("layer", F.lit("batch"))
        .unionByName(speed.where(F.col(time_column) >= at).withColumn("layer", F.lit("speed")))
    )


def period_end(first: date, grain: str) -> date:
    """The day after a period that begins on ``first``."""
    if grain == "day":
        return first + timedelta(days=1)
    months = 1 if grain == "month" else 12
    year, month = divmod(first.year * 12 + first.month - 1 + months, 12)
    return date(year, month + 1, 1)


class Handover:
    """A day from which the speed layer answers, and before which the batch layer does; it moves when Gold has taken in more of Silver.

    The cut-offs are a table of versions and the newest one counts, so moving it is one append: a reader sees all days by the old one or all by the new one. Gold is written
    before the cut-off moves, when its days behind the old one are not read yet; the speed layer's windows are retired one hand-over later, when no reader asks for them
    any more. Exports come in the order of their periods; what comes later for a period that is handed over reaches readers with the next refresh.
    """

    def __init__(self, lake: Lake, name: str, gold: AdditiveGold, speed: WindowedTotals):
        self.lake, self.gold, self.speed, self.table = lake, gold, speed, f"{name}_cut_offs"
        lake.ensure(self.table, CUT_OFFS)

    def cut_off(self) -> date | None:
        newest = self.lake.read(self.table).orderBy(F.desc("version")).first()
        return newest["cut_off"] if newest else None

    def promoted_to(self) -> date | None:
        """The day after the last period that Gold has whole."""
        last = self.lake.read(self.gold.runs).where(F.col("state") == DONE).agg(F.max(PERIOD)).first()[0]
        return period_end(last, self.gold.grain()) if last else None

    def hand_over(self) -> bool:
        """Let the batch layer answer for all that it has; False if that is no more than before."""
        before, to = self.cut_off(), self.promoted_to()
        if to is None or (before is not None and to <= before):
            return False
        version = (self.lake.read(self.table).agg(F.max("version")).first()[0] or 0) + 1
        self.lake.append(self.table, self.lake.spark.createDataFrame([(version, to)], CUT_OFFS).coalesce(1))
        if before is not None:
            self.speed.settle(datetime.combine(before, time()))
        return True

    def wanted(self, stream: DataFrame, day: str) -> DataFrame:
        """What the speed layer still has to take of a stream: the filter stands at the source."""
        cut = self.cut_off()
        return stream if cut is None else stream.where(F.col(day) >= F.lit(cut))

    def view(self, day: str, keys: Sequence[str], n: str, total: str, total_of: str) -> DataFrame:
        """``day``, ``keys``, ``n``, ``total`` and ``layer``: Gold's days before the cut-off, the stream's windows from it on."""
        cut = self.cut_off()

        def within(column: str, before: bool) -> Column:
            if cut is None:
                return F.lit(not before)
            return F.col(column) < F.lit(cut) if before else F.col(column) >= F.lit(cut)

        batch = self.lake.read(self.gold.daily).where(within(day, True)).groupBy(day, *keys).agg(F.sum("n_rows").alias(n), F.sum(total_of).alias(total))
        speed = self.speed.windows().withColumn(day, F.to_date("window_start")).where(within(day, False))
        shown = [day, *keys, F.col("n_events").alias(n), F.col("total_value").alias(total), F.lit("speed").alias("layer")]
        return batch.withColumn("layer", F.lit("batch")).unionByName(speed.select(*shown))
