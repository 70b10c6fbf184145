"""Bronze and Silver: land, check, merge and promote one feed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.expressions import on_day
from stockflow.lake import FEW_PARTITIONS, PERIOD, Lake, cast_to, materialise
from stockflow.model import ACCOUNTING, CHANGES, MONITORING, TableSpec
from stockflow.operators import filters, merge, quality
from stockflow.sources import landing

MONITORING_TABLE = "bronze_table_monitoring"
ACCOUNTING_TABLE = "load_accounting"
Moment = datetime | str


def bronze_table(spec: TableSpec) -> str:
    return f"bronze_{spec.name}"


def silver_table(spec: TableSpec) -> str:
    return f"silver_{spec.name}"


def quarantine_table(spec: TableSpec) -> str:
    return f"quarantine_{spec.name}"


def rejected_table(spec: TableSpec) -> str:
    return f"rejected_{spec.name}"


def changes_table(spec: TableSpec) -> str:
    return f"changes_{spec.name}"


def promoted_table(spec: TableSpec) -> str:
    return f"promoted_{spec.name}"


def add_load_columns(df: DataFrame, processed_at: Moment, source_system: str) -> DataFrame:
    return df.withColumns(
        {"processed_date": F.lit(processed_at).cast("timestamp"), "source_system": F.lit(source_system)}
    )


def load_bronze(
    lake: Lake,
    spec: TableSpec,
    landing_dir: str,
    processed_at: Moment,
    since: Moment | None = None,
    source_system: str = "ERP",
    on_duplicate: str = "latest",
    grain: str = "day",
    same_day: bool = False,
    until: Moment | None = None,
) -> None:
    """Exports from ``since`` on (and before ``until``), into raw, rejected, Bronze and monitoring tables.

    The text is parsed and checked once, into the raw table; the later steps read that, pruned to the batch's
    exports and to their columns. One aggregate by key, over the keys that more than one row may have, and one by export serve all steps after that. A key that one export repeats is rejected; of versions in several exports the newest stays. Rejected rows replace those of an earlier run of the same export, so a rerun changes nothing but
    adds its monitoring rows, which come last: they tell of a load that succeeded.
    """
    exports = landing.list_exports(lake.spark, landing_dir, spec.name, since, until, same_day)
    batch = landing.read_landing(lake.spark, spec, exports)
    if batch is None:
        return
    landing.write_raw(lake, spec, quality.check_raw(batch, spec))
    taken = [F.lit(e.taken.isoformat(" ")).cast("timestamp") for e in exports]
    checked = lake.read(landing.raw_table(spec)).where(F.col(landing.RAW_PARTITION).isin(taken))
    versions = materialise(quality.key_versions(quality.sharing(checked, spec), spec), "key-versions")
    counts = materialise(quality.export_counts(checked, spec), "export-counts")
    repeated = quality.repeats_of(versions, spec)
    again = not repeated.isEmpty()
    if again:
        checked = quality.with_repeats(checked, spec, repeated)
    several = quality.keys_with_versions(versions, spec)

    some = again or not counts.where("bad > 0").isEmpty()
    store_rejected(lake, spec, quality.rejected(checked), exports, some)
    rows = add_load_columns(quality.accepted(checked, spec), processed_at, source_system)
    merge.upsert(
        lake,
        bronze_table(spec),
        spec.schema,
        rows,
        spec.keys,
        spec.date_key,
        on_duplicate,
        spec.latest_by,
        grain,
        before_write=lambda periods: note_changes(lake, changes_table(spec), periods),
        repeated=not several.isEmpty(),
        repeated_keys=several,
    )
    lake.ensure(MONITORING_TABLE, MONITORING)
    lake.append(MONITORING_TABLE, quality.monitoring_of(counts, spec).coalesce(1))
    lake.ensure(ACCOUNTING_TABLE, ACCOUNTING)
    lake.append(ACCOUNTING_TABLE, quality.accounting_of(versions, counts).coalesce(1))


def store_rejected(lake: Lake, spec: TableSpec, rows: DataFrame, exports: Sequence[landing.Export], some: bool = True) -> None:
    """Rejected rows by export time. An export that is landed again loses its former rejects, also if it has none now; ``some`` says whether there are any."""
    lake.ensure(rejected_table(spec), rows.schema, partition_by=landing.RAW_PARTITION)
    found = set()
    if some:
        lake.replace_partitions(rejected_table(spec), rows, landing.RAW_PARTITION, rebalance=False)
        # Written first: a run that breaks off here leaves former rejects, never none.
        found = {row[0] for row in rows.select(landing.RAW_PARTITION).distinct().toLocalIterator()}
    lake.drop_partitions(rejected_table(spec), landing.RAW_PARTITION, [e.taken for e in exports if e.taken not in found])


def note_changes(lake: Lake, table: str, periods: Sequence[date]) -> None:
    """Which periods a load is about to rewrite: at most as many rows as the calendar has periods."""
    load_id = uuid.uuid4().hex
    lake.ensure(table, CHANGES)
    lake.append(table, lake.spark.createDataFrame([(load_id, p) for p in periods], CHANGES).coalesce(1))


def promote_silver(
    lake: Lake,
    spec: TableSpec,
    day: Moment | None = None,
    on_duplicate: str = "latest",
    grain: str = "day",
    parents: Mapping[str, DataFrame] | None = None,
) -> None:
    """The Bronze periods that loads have changed since they were last promoted, with exact decimals, merged by key.

    Loads note their periods before they write, and promotions are noted after they have written. So a load of an older or an equal moment
    is promoted as well, a missed run is caught up, and one that broke off is done again; only partitions of these periods are read.
    ``day`` takes the rows processed on that day instead. An error of the merge is raised, not hidden.

    With ``parents`` (dimensions by name) rows that refer to an unknown one stay in quarantine; ``release_quarantine`` lets them in later. Silver keeps the last version of a
    key that passed.
    """
    lake.ensure_by_date(silver_table(spec), spec.silver_schema(), grain)
    bronze = lake.read(bronze_table(spec))
    pending = None
    if day is not None:
        fresh = bronze.where(on_day(F.col("processed_date"), F.lit(day)))
    else:
        for table in (changes_table(spec), promoted_table(spec)):
            lake.ensure(table, CHANGES)
        done = lake.read(promoted_table(spec))
        pending = materialise(lake.read(changes_table(spec)).join(done, ["load_id", "period"], "left_anti"), "pending")
        periods = [row["period"] for row in pending.select("period").distinct().toLocalIterator()]
        if not periods:
            return
        fresh = bronze.where(F.col(PERIOD).isin(periods))
    if parents is not None:
        fresh = keep_apart(lake, spec, fresh, parents, None if pending is None else periods)
    merge.upsert(
        lake,
        silver_table(spec),
        spec.silver_schema(),
        fresh,
        spec.keys,
        spec.date_key,
        on_duplicate,
        spec.latest_by,
        grain,
    )
    if pending is not None:
        lake.append(promoted_table(spec), pending)


def keep_apart(lake: Lake, spec: TableSpec, rows: DataFrame, parents: Mapping[str, DataFrame], periods: Sequence[date] | None) -> DataFrame:
    """Put rows with an unknown reference into quarantine, in place of what whole ``periods`` had there, and return the others.

    The quarantine is written first and then joined by key, so the rows are checked once; a run that breaks off here is done again.
    """
    schema = T.StructType([*spec.silver_schema(), T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField(PERIOD, T.DateType())])
    table = quarantine_table(spec)
    lake.ensure(table, schema, PERIOD, lake.grain(bronze_table(spec)))
    suspect, _ = quality.split_unknown(rows, spec, parents)
    found = materialise(cast_to(suspect.where(F.size("reasons") > 0), schema), "unknown")
    touched = [row[PERIOD] for row in found.select(PERIOD).distinct().toLocalIterator()]
    if periods is None:  # single rows of periods: what else waits there goes on waiting
        waiting = lake.read(table).where(F.col(PERIOD).isin(touched)).join(found.select(*spec.keys), list(spec.keys), "left_anti")
        lake.replace_partitions(table, found.unionByName(waiting))
    else:
        lake.replace_partitions(table, found, rebalance=len(touched) > FEW_PARTITIONS)
        lake.drop_labels(table, PERIOD, sorted(str(p) for p in set(periods) - set(touched)))
    return rows if not touched else filters.without(rows, found, spec.keys)


def release_quarantine(lake: Lake, spec: TableSpec, parents: Mapping[str, DataFrame], grain: str = "day") -> int:
    """Let the rows into Silver whose references have become known, and only read those that wait; the number of rows let in.

    They enter Silver first and leave the quarantine then, and their periods are noted as promoted for what is kept by changes. A run that breaks off is done again.
    """
    table = quarantine_table(spec)
    if not lake.exists(table):
        return 0
    waiting = lake.read(table)
    checked = quality.with_unknown(waiting, spec, parents)
    free = materialise(checked.where(F.size("reasons") == 0).select(*waiting.drop("reasons").columns), "released")
    periods = [row[PERIOD] for row in free.select(PERIOD).distinct().toLocalIterator()]
    if not periods:
        return 0
    merge.upsert(lake, silver_table(spec), spec.silver_schema(), free, spec.keys, spec.date_key, "latest", spec.latest_by, grain)
    note_changes(lake, promoted_table(spec), periods)
    left = materialise(filters.without(waiting.where(F.col(PERIOD).isin(periods)), free, spec.keys), "still-waiting")
    kept = {row[PERIOD] for row in left.select(PERIOD).distinct().toLocalIterator()}
    lake.replace_partitions(table, left, rebalance=len(kept) > FEW_PARTITIONS)
    lake.drop_labels(table, PERIOD, sorted(str(p) for p in set(periods) - kept))
    return free.count()
