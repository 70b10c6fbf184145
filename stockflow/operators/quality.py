"""Row and schema checks. Rejected rows keep their values and say why."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.expressions import all_not_null, reasons
from stockflow.lake import materialise
from stockflow.model import MALFORMED, SCHEMA_FAULT, TableSpec
from stockflow.operators import filters

REPEATED = "duplicate_key"
UNKNOWN = "unknown:"


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are all present, and the NULL count of each key."""
    return df.where(all_not_null(keys)), null_key_counts(df, keys)


def null_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from a single pass; a row with two NULL keys counts for both."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return counted.unpivot(["rows"], list(keys), "merge_key", "nulls_dropped")


def schema_diff(actual: T.StructType, expected: T.StructType) -> dict[str, list[str]]:
    """Column-level comparison: missing, extra, and present with another type."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in expected}
    return {
        "missing": [c for c in want if c not in have],
        "extra": [c for c in have if c not in want],
        "mismatched": [c for c in want if c in have and have[c] != want[c]],
    }


def try_typed(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns in the schema's types; a value that does not fit becomes NULL."""
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*typed, *[F.col(c) for c in keep])


def row_reasons(
    schema: T.StructType,
    keys: Sequence[str],
    malformed: str | None = None,
    strict: Mapping[str, T.DataType] | None = None,
    dates: tuple[str, str] | None = None,
):
    """Why a text row is not acceptable: malformed line, NULL key, value that does not fit its type, date out of range.

    ``strict`` names narrower types that values of some columns will have later; what does not fit them (too many digits, NaN, infinities)
    is refused here, where it can be isolated.
    """
    strict = strict or {}
    checks = [(F.col(malformed).isNotNull(), "malformed_row")] if malformed else []
    checks += [(F.col(k).isNull(), f"null_key:{k}") for k in keys]
    checks += [
        (F.col(f.name).isNotNull() & F.col(f.name).try_cast(strict.get(f.name, f.dataType)).isNull(), f"type:{f.name}")
        for f in schema
        if f.dataType != T.StringType()
    ]
    if dates:
        low, high = (F.lit(d).cast("date") for d in dates)
        checks += [(~F.col(f.name).try_cast("date").between(low, high), f"range:{f.name}") for f in schema if f.dataType == T.DateType()]
    return reasons(*checks)


def check_raw(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Landed rows with their ``reasons``; accepted and rejected rows are filters on that column.

    The rules of the specification (allowed values, ranges, lengths) are checked with the types, in the same pass.
    """
    strict = {f.name: f.dataType for f in spec.silver_schema() if f.name in spec.money}
    row = row_reasons(spec.landing_schema(), spec.keys, MALFORMED, strict, spec.dates)
    rules = rule_checks(spec.domains, spec.ranges, spec.max_lengths, value=lambda c: F.col(c).try_cast("double"))
    if rules:
        row = F.concat(row, reasons(*rules))
    whole = F.array(F.col(SCHEMA_FAULT))
    return raw.withColumn("reasons", F.when(F.col(SCHEMA_FAULT).isNotNull(), whole).otherwise(row)).drop(SCHEMA_FAULT)


def repeated_in_export(checked: DataFrame, spec: TableSpec, export: str = "source_file") -> DataFrame:
    """Keys, in their types, that acceptable rows of one export hold more than once. Only key columns are shuffled."""
    keys = [F.col(k).try_cast(spec.schema[k].dataType).alias(k) for k in spec.keys]
    return checked.where(F.size("reasons") == 0).groupBy(export, *keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def with_repeats(checked: DataFrame, spec: TableSpec, repeated: DataFrame, export: str = "source_file") -> DataFrame:
    """Refuse all rows of a key that its export repeats: which of them is right cannot be told. Versions are chosen between exports only.

    Only rows that may have such a key are joined and stored; the others are read where they are.
    """
    typed = [F.col(k).try_cast(spec.schema[k].dataType) for k in spec.keys]
    checked, others = filters.split(checked, [F.col(export), *typed], repeated, [export, *spec.keys])
    known = repeated.select(export, *[F.col(k).alias(f"_{k}") for k in spec.keys])
    same = checked[export] == known[export]
    for k in spec.keys:
        same &= checked[k].try_cast(spec.schema[k].dataType) == known[f"_{k}"]
    joined = checked.join(known, same, "left").drop(known[export])
    again = F.col(f"_{spec.keys[0]}").isNotNull() & (F.size("reasons") == 0)
    marked = joined.withColumn("reasons", F.when(again, F.array(F.lit(REPEATED))).otherwise(F.col("reasons")))
    return others.unionByName(materialise(marked.select(*checked.columns), "marked"))


def key_versions(checked: DataFrame, spec: TableSpec, when: str = "ingestion_date") -> DataFrame:
    """One row per key of the acceptable rows, with ``versions``: for each export that has it, the number of its rows and the newest one's order.

    The one aggregate by key of a load: repeats, the choice of versions, the periods of the merge and the accounting are read from it. Rows are counted in the map tasks before
    they are shuffled, and a key has as many versions as the batch has exports at most.
    """
    keys = [F.col(k).try_cast(spec.schema[k].dataType).alias(k) for k in spec.keys]
    order = F.struct(*[F.col(c).try_cast(spec.schema[c].dataType).alias(f"_{i}") for i, c in enumerate(spec.latest_by)])
    counted = checked.where(F.size("reasons") == 0).groupBy("source_file", when, *keys).agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("newest"))
    version = F.struct("newest", "source_file", F.col(when).alias("taken"), "n")
    return counted.groupBy(*spec.keys).agg(F.collect_list(version).alias("versions"))


def sharing(checked: DataFrame, spec: TableSpec) -> DataFrame:
    """The acceptable rows that may share their key with another row: all that do, and hardly any other.

    Rows are counted by a 64-bit print of their key, so a shuffle carries a number a row and not the keys; where no two rows share one, nothing more is read. The rows of
    shared prints are told by their bits and are not shuffled for it.
    """
    mark = F.xxhash64(*[F.col(k).try_cast(spec.schema[k].dataType) for k in spec.keys])
    good = checked.where(F.size("reasons") == 0)
    shared = materialise(repeated_prints(good.select(mark.alias("_print"))), "shared-prints")
    if shared.isEmpty():
        return good.limit(0)
    return filters.split(good, [mark], shared, ["_print"])[0]


def repeated_prints(prints: DataFrame) -> DataFrame:
    return prints.groupBy("_print").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_print")


def single_versions() -> Column:
    """Versions that their export does not repeat."""
    return F.filter("versions", lambda v: v["n"] == 1)


def repeats_of(versions: DataFrame, spec: TableSpec) -> DataFrame:
    """Exports and keys that they repeat, as ``repeated_in_export`` gives them."""
    each = versions.where(F.exists("versions", lambda v: v["n"] > 1)).select(*spec.keys, F.explode("versions").alias("v")).where("v.n > 1")
    return each.select(F.col("v.source_file").alias("source_file"), *spec.keys, F.col("v.n").alias("n_rows"))


def keys_with_versions(versions: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of which a load merges more than one row."""
    return versions.where(F.size(single_versions()) > 1).select(*spec.keys)


def several_versions(versions: DataFrame) -> bool:
    """Whether a load merges more than one row of some key."""
    return not versions.where(F.size(single_versions()) > 1).isEmpty()


def export_counts(checked: DataFrame, spec: TableSpec, when: str = "ingestion_date") -> DataFrame:
    """Per export: rows, rows that are not acceptable by themselves, rows that do not fit the schema, NULLs of each key. One row an export."""
    nulls = [F.count_if(F.col(k).isNull()).alias(k) for k in spec.keys]
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size("reasons") > 0).alias("bad"), F.count_if(unfit()).alias("incompatible")]
    return checked.groupBy(F.col(when).alias("date"), "source_file").agg(*counts, *nulls)


def unfit() -> Column:
    return F.exists("reasons", lambda r: r.startswith("type:") | r.startswith("schema:") | (r == "malformed_row"))


def monitoring_of(counts: DataFrame, spec: TableSpec) -> DataFrame:
    """``monitoring_rows`` from the counts of the exports."""
    return counts.drop("bad").unpivot(["date", "source_file", "rows", "incompatible"], list(spec.keys), "merge_key", "nulls_dropped")


def accounting_of(versions: DataFrame, counts: DataFrame) -> DataFrame:
    """``accounting`` from the versions of the keys and the counts of the exports: nothing is shuffled by key again.

    ``versions`` may leave out keys with a single row, which is accepted.
    """
    chosen = F.array_max(single_versions())
    each = versions.select(F.explode("versions").alias("v"), chosen.alias("c"))
    new, twice = (F.col("v") == F.col("c")).cast("long"), F.when(F.col("v.n") > 1, F.col("v.n")).otherwise(0)
    placed = each.select(F.col("v.taken").alias("date"), F.col("v.source_file").alias("source_file"), F.coalesce(new, F.lit(0)).alias("new"), twice.alias("twice"), F.col("v.n").alias("n"))
    summed = placed.groupBy("date", "source_file").agg(*[F.sum(c).alias(c) for c in ("new", "twice", "n")])
    none = F.lit(0).cast("long")
    known = {c: F.coalesce(F.col(c), none) for c in ("new", "twice", "n")}
    return counts.join(summed, ["date", "source_file"], "left").select(
        "date",
        "source_file",
        F.col("rows").alias("landed"),
        (F.col("rows") - F.col("bad") - known["n"] + known["new"]).alias("accepted"),
        (F.col("bad") + known["twice"]).alias("rejected"),
        (known["n"] - known["twice"] - known["new"]).alias("superseded"),
    )


def accounting(checked: DataFrame, spec: TableSpec, when: str = "ingestion_date") -> DataFrame:
    """Per export: rows landed, rejected, superseded by a newer version in the same batch, and accepted."""
    keys = [F.col(k).try_cast(spec.schema[k].dataType) for k in spec.keys]
    order = [F.col(c).try_cast(spec.schema[c].dataType).desc_nulls_last() for c in spec.latest_by]
    good = F.size("reasons") == 0
    newest = F.row_number().over(Window.partitionBy(good, *keys).orderBy(*order)) == 1
    placed = checked.where(good).withColumn("newest", newest).select(when, "source_file", F.lit(0).alias("bad"), F.col("newest").cast("int").alias("new"))
    refused = checked.where(~good).select(when, "source_file", F.lit(1).alias("bad"), F.lit(0).alias("new"))
    counted = placed.unionByName(refused).groupBy(F.col(when).alias("date"), "source_file")
    return counted.agg(F.count(F.lit(1)).alias("landed"), F.sum("new").alias("accepted"), F.sum("bad").alias("rejected"), F.sum(1 - F.col("bad") - F.col("new")).alias("superseded"))


def accepted(checked: DataFrame, spec: TableSpec) -> DataFrame:
    return try_typed(checked.where(F.size("reasons") == 0), spec.landing_schema())


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def monitoring_rows(checked: DataFrame, spec: TableSpec, when: str = "ingestion_date") -> DataFrame:
    """Per source file and merge key: rows, NULL keys and rows that do not fit the schema.

    Only the counters of each file leave the executors, however large a file is.
    """
    return monitoring_of(export_counts(checked, spec, when), spec)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Partial counts are made before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def with_violations(
    df: DataFrame,
    domains: Mapping[str, Sequence[str]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    max_lengths: Mapping[str, int] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Add ``reasons`` for broken row rules. As in SQL CHECK constraints, NULL passes all but ``required``."""
    checks = [(F.col(c).isNull(), f"required:{c}") for c in required]
    return df.withColumn("reasons", reasons(*checks, *rule_checks(domains, ranges, max_lengths)))


def rule_checks(
    domains: Mapping[str, Sequence[str]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    max_lengths: Mapping[str, int] | None = None,
    value: Callable[[str], Column] = F.col,
) -> list[tuple[Column, str]]:
    """Conditions under which a row breaks a rule, each with its label. ``value`` reads a number, which may still be text."""
    checks = [(~F.col(c).isin(*allowed), f"domain:{c}") for c, allowed in (domains or {}).items()]
    checks += [(~value(c).between(low, high), f"range:{c}") for c, (low, high) in (ranges or {}).items()]
    return checks + [(F.length(c) > n, f"length:{c}") for c, n in (max_lengths or {}).items()]


def unknown_references(df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """By column, the references that are set and have no parent, each once, and all that are set. References to parents that are not given are not checked."""
    found = {}
    for fk in (fk for fk in spec.foreign_keys if fk.parent in parents):
        known = parents[fk.parent].select(F.col(fk.parent_column).cast(df.schema[fk.column].dataType).alias(fk.column))
        used = df.where(F.col(fk.column).isNotNull()).select(fk.column).distinct()
        unknown = materialise(used.join(known, fk.column, "left_anti"), f"unknown-{fk.column}")
        if not unknown.isEmpty():
            found[fk.column] = unknown, used
    return found


def split_unknown(df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Rows that may refer to something unknown, with their ``reasons``, and the others.

    The references are compared with the parents, each once. A row that passes the bits of the unknown references, and not those of the known ones that pass them by chance,
    refers to an unknown one for certain; rows that pass both are joined. So a row is never repeated, and hardly any is shuffled.
    """
    df = df.drop("reasons")
    columns, never = df.columns, F.lit(False)
    may, doubtful, checks, joins = never, never, [], []
    for column, (unknown, used) in unknown_references(df, spec, parents).items():
        bits = filters.KeyBits(unknown, [column])
        passed = bits.flag(used, [F.col(column)], "_passed").where("_passed").select(column)
        spared = materialise(passed.join(unknown, column, "left_anti"), f"spared-{column}")
        df = bits.flag(df, [F.col(column)], f"_may_{column}")
        df = df.withColumn(f"_may_{column}", F.col(f"_may_{column}") & F.col(column).isNotNull())
        df = filters.KeyBits(spared, [column]).flag(df, [F.col(column)], f"_spared_{column}")
        may |= F.col(f"_may_{column}")
        doubtful |= F.col(f"_may_{column}") & F.col(f"_spared_{column}")
        checks.append((F.col(f"_may_{column}"), f"{UNKNOWN}{column}"))
        joins.append((column, unknown.select(F.col(column).alias(f"_missing_{column}"))))
    why = reasons(*checks) if checks else F.array().cast("array<string>")
    certain = df.where(may & ~doubtful).select(*columns, why.alias("reasons"))
    unsure = df.where(may & doubtful)
    for column, missing in joins:
        unsure = unsure.join(missing, F.col(column) == F.col(f"_missing_{column}"), "left").withColumn(f"_may_{column}", F.col(f"_missing_{column}").isNotNull())
    return certain.unionByName(unsure.select(*columns, why.alias("reasons"))), df.where(~may).select(*columns)


def with_unknown(df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``reasons``: the references that are set but have no parent."""
    suspect, others = split_unknown(df, spec, parents)
    return others.withColumn("reasons", F.array().cast("array<string>")).unionByName(suspect)


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break a rule of their specification."""
    return rejected(with_violations(df, spec.domains, spec.ranges, spec.max_lengths, spec.keys))


def foreign_key_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference is set but has no parent.

    The sides are joined as scanned, so the adaptive planner broadcasts a small parent, and otherwise splits the
    partition of a reference that most rows share.
    """
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs; a default may be a literal or a column expression such as ``current_timestamp()``."""
    types = {f.name: f.dataType for f in df.schema}
    filled = {
        c: F.coalesce(F.col(c), (v if hasattr(v, "alias") else F.lit(v)).cast(types[c])) for c, v in defaults.items()
    }
    return df.withColumns(filled)
