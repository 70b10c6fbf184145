"""Upsert by key into parquet tables, and the choice of one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import FEW_PARTITIONS, PERIOD, Lake
from stockflow.functions.expressions import period_start
from stockflow.operators import filters

#: A batch up to so many rows is merged by one join, as its keys are broadcast.
SMALL_BATCH = 100_000
#: What rows of a target a batch meets.
NOTHING, SOME, EVERYTHING = "nothing", "some", "everything"


class DuplicateKeys(ValueError):
    """The batch holds more than one row for a key."""


class AmbiguousMerge(ValueError):
    """Several rows of the batch match one row of the target."""


class NullKeys(ValueError):
    """NULL keys never match, so each run would insert them again."""


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str | Column]) -> DataFrame:
    """The newest row of each key.

    Spark keeps the first row per key in each map task before the shuffle (a window group limit), so a key that
    many rows share sends one row per task. ``latest_by`` is newest first and must decide ties. Without keys all rows are one group.
    """
    if not latest_by:
        raise ValueError("latest_per_key needs an order")
    newest = [c if isinstance(c, Column) else F.col(c).desc_nulls_last() for c in latest_by]
    if not keys:
        return df.orderBy(*newest).limit(1)  # each task passes on one row
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return ranked.where("_rank = 1").drop("_rank")


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], source_keys: DataFrame | None = None
) -> DataFrame:
    """MERGE that updates every column of a match and inserts the rest: the source, and what it does not match.

    Only the source's keys are joined, as an anti join: a small batch is broadcast at run time and the target is
    not shuffled; a large one is a sort-merge join whose skewed target partitions are split. ``source_keys`` may
    name a cheaper relation with the same set of keys.
    """
    matched = (source if source_keys is None else source_keys).select(*keys)
    kept = target.join(matched, list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def merge_conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that more than one source row matches, with the number of those rows."""
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    return repeated.join(target.select(*keys), list(keys), "left_semi")


def upsert(
    lake: Lake,
    table: str,
    schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str],
    date_key: str,
    on_duplicate: str = "error",
    latest_by: Sequence[str | Column] = (),
    grain: str = "day",
    before_write: Callable[[list[date]], None] | None = None,
    repeated: bool | None = None,
    repeated_keys: DataFrame | None = None,
) -> None:
    """Merge ``source`` into a table partitioned by the period of its date key.

    ``on_duplicate``: "error" refuses a batch with repeated keys; "latest" keeps the newest row of each key;
    "insert" lets repeated keys in as long as they match no row of the target, as SQL MERGE does.

    The date is part of the key, so a match lies in the same period: only the periods of the batch are read and
    rewritten; ``before_write`` is told which, before any is. One writer at a time; readers may see some partitions before others. A rerun gives the same rows.
    ``repeated`` may say whether two rows of ``source`` share a key, where that is known already, and ``repeated_keys`` (stored, in the types of the table) which keys they share:
    then only rows that may have one of these are shuffled to choose between them.
    """
    if date_key not in keys:
        raise ValueError("the date key must be one of the merge keys")
    if on_duplicate not in ("error", "latest", "insert"):
        raise ValueError("on_duplicate must be 'error', 'latest' or 'insert'")
    lake.ensure_by_date(table, schema, grain)
    grain = lake.grain(table)
    order_only = [c for c in latest_by if isinstance(c, str) and c not in schema.fieldNames()]
    extra = [source[c] for c in order_only]
    typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], *extra)
    rows = typed.withColumn(PERIOD, period_start(F.col(date_key), grain))

    null_key = F.lit(False)
    for key in keys:
        null_key |= F.col(key).isNull()
    # One pass over the key columns gives the periods touched (a bounded list) and the state of the keys; a print of the key is shuffled, a number a row.
    of_key = [F.xxhash64(*keys).alias("_print")] if repeated is None else []
    counted = rows.groupBy(*of_key, PERIOD).agg(F.count(F.lit(1)).alias("n"), F.bool_or(null_key).alias("has_null"))
    profile = counted.groupBy(PERIOD).agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.bool_or("has_null").alias("has_null")).collect()
    if not profile:
        return
    if any(p["has_null"] for p in profile):
        raise NullKeys(f"{table}: drop rows with NULL keys before the merge")
    if repeated is None:  # keys that differ may have one print
        repeated = any(p["most"] > 1 for p in profile) and not rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    periods = [p[PERIOD] for p in profile]
    target = lake.read(table).where(F.col(PERIOD).isin(periods))

    if repeated and on_duplicate == "error":
        raise DuplicateKeys(f"{table}: the batch repeats a key ({', '.join(keys)})")
    landed = rows
    if repeated and on_duplicate == "latest":
        if repeated_keys is None:
            rows = latest_per_key(rows, keys, latest_by)
        else:
            may, others = filters.split(rows, [F.col(k) for k in keys], repeated_keys, keys)
            rows = others.unionByName(latest_per_key(may, keys, latest_by))
    if repeated and on_duplicate == "insert" and not merge_conflicts(target, rows, keys).isEmpty():
        raise AmbiguousMerge(f"{table}: several rows of the batch match one row of the table")
    # Choosing one row per key does not change the set of keys, so the join need not wait for it; and in periods
    # the table does not have yet there is nothing to join.
    known = lake.partitions(table, PERIOD).where(F.col(PERIOD).isin([str(p) for p in periods])).count()
    met = meeting(target, keys, landed, sum(p["n"] for p in profile)) if known else NOTHING
    if before_write:
        before_write(periods)
    many = len(periods) > FEW_PARTITIONS
    if met == NOTHING and known == len(periods):  # so the batches of a stream do not rewrite what those before have brought
        lake.append(table, rows, PERIOD if many else None)
    else:  # the folder of a period that the catalog does not know may hold what a broken-off write has left
        lake.replace_partitions(table, merged_by(met, target, rows, keys, landed) if known else rows, rebalance=many)


def meeting(target: DataFrame, keys: Sequence[str], source_keys: DataFrame, n_source: int) -> str:
    """Whether a large source has the key of all rows of the target, of none, or what is not known, as for a small one: some.

    Fewer rows than the target has are not expected to have all its keys.
    """
    if n_source > SMALL_BATCH:
        matched = source_keys.select(*keys).hint("merge")  # the size of compressed files says little of the memory that many keys take
        if n_source >= target.count() and target.select(*keys).join(matched, list(keys), "left_anti").isEmpty():
            return EVERYTHING
        if target.select(*keys).join(matched, list(keys), "left_semi").isEmpty():
            return NOTHING
    return SOME


def merged_by(met: str, target: DataFrame, source: DataFrame, keys: Sequence[str], source_keys: DataFrame) -> DataFrame:
    if met == EVERYTHING:
        return source.select(*target.columns)
    if met == NOTHING:
        return target.unionByName(source.select(*target.columns))
    return merge_rows(target, source, keys, source_keys)


def merge_whole(target: DataFrame, source: DataFrame, keys: Sequence[str], source_keys: DataFrame, n_source: int) -> DataFrame:
    """``merge_rows`` that looks at the keys alone first where the source is large.

    A load that comes again replaces all it meets, and late rows meet nothing: then no whole row of the target need be shuffled.
    """
    return merged_by(meeting(target, keys, source_keys, n_source), target, source, keys, source_keys)
