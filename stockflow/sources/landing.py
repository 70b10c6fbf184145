"""Landing zone (CSV exports named after feed and time) and raw zone (strings as landed, by export time).

An export is either one file ``sales_20260105_180500.csv`` or, at scale, a folder of that name, or of the form
``export=sales_20260105_180500.csv``, holding the part files of one distributed write.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.lake import Lake, glob_paths
from stockflow.model import MALFORMED, SCHEMA_FAULT, TableSpec
from stockflow.session import session_conf

# Landing files are named <feed>_<yyyyMMdd>_<HHmmss>.csv.
STAMP_FORMAT, STAMP_PARSE, STAMP_LENGTH = "yyyyMMdd_HHmmss", "%Y%m%d_%H%M%S", 15
STAMP_GLOB = "[0-9]" * 8 + "_" + "[0-9]" * 6
SUFFIX = ".csv"
# End of fixed values.

# Doubled quotes inside quoted fields, as spreadsheet and data-frame tools write them.
CSV_OPTIONS = {"header": "true", "escape": '"'}
#: Exports are written once and read a few times: speed counts more than the last fifth of their size.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
RAW_PARTITION = "ingestion_date"
REASONS = "reasons"
RESCUED = "rescued"
#: Shuffled bytes that a task of an export takes, and how many times the session's shuffle partitions there may be for it.
EXPORT_SPLIT, FINER = "16m", 5
#: First lines of part files fetched at once.
HEADER_THREADS = 16


@dataclass(frozen=True)
class Export:
    """One export: where it lies, its plain name, and the time in that name (UTC)."""

    path: str
    name: str
    taken: datetime


def export_csv(df: DataFrame, landing_dir: str, feed: str, exported_at: Column, rebalance: bool = True) -> None:
    """Write one export per distinct time, as compressed part files; no rows, no export.

    ``rebalance`` shuffles the whole feed to make few part files. Without it each task writes a file for each export it has rows of, which is right
    where exports are few and read as a whole; the shuffles before it are then cut finer, as a task also sorts its rows by export.
    """
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    finer = {"spark__sql__adaptive__coalescePartitions__initialPartitionNum": str(FINER * most), "spark__sql__adaptive__advisoryPartitionSizeInBytes": EXPORT_SPLIT}
    name = F.concat(F.lit(f"{feed}_"), F.date_format(exported_at, STAMP_FORMAT), F.lit(SUFFIX))
    rows = df.withColumn("export", name)
    written = rows.hint("rebalance", "export") if rebalance else rows
    with session_conf(df.sparkSession, **({} if rebalance else finer)):
        written.write.partitionBy("export").options(**{**CSV_OPTIONS, **GZIP}).mode("append").csv(landing_dir)


def moment(value: datetime | str) -> datetime:
    """A time in UTC without offset, from a datetime or ISO text with or without an offset."""
    taken = datetime.fromisoformat(value) if isinstance(value, str) else value
    return (taken - taken.utcoffset()).replace(tzinfo=None) if taken.tzinfo else taken


def list_exports(
    spark: SparkSession,
    landing_dir: str,
    feed: str,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    same_day: bool = False,
) -> list[Export]:
    """The feed's exports from ``since`` on, that second included, oldest first.

    Only the names in the landing folder are read, and they decide: the part files of exports outside the window
    are never listed. Other files and other feeds do not match. The window is open-ended, so that exports made
    after midnight count; ``same_day`` restores the one-day rule.
    """
    found = []
    for path in glob_paths(spark, f"{landing_dir}/{{{feed}_{STAMP_GLOB}{SUFFIX},*={feed}_{STAMP_GLOB}{SUFFIX}}}"):
        name = path.rsplit("/", 1)[-1].rsplit("=", 1)[-1]
        try:
            taken = datetime.strptime(name.removeprefix(f"{feed}_").removesuffix(SUFFIX), STAMP_PARSE)
        except ValueError:
            continue
        if since is not None and taken < moment(since):
            continue
        if same_day and since is not None and taken.date() != moment(since).date():
            continue
        if until is not None and taken >= moment(until):
            continue
        found.append(Export(path, name, taken))
    return sorted(found, key=lambda e: (e.taken, e.path))


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The files of an export that hold something, by name: the export itself, or all in its folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(top, True)
    found = []
    while files.hasNext():
        status = files.next()
        if status.getLen() > 0 and not status.getPath().getName().startswith(("_", ".")):
            found.append(status.getPath().toString())
    return sorted(found)


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of a file, which may be compressed. No Spark job runs, and no more is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        stream = codec.createInputStream(stream) if codec else stream
        text = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([(text or "").removeprefix("\ufeff")]), ()))


def by_header(spark: SparkSession, exports: Sequence[Export]) -> dict[tuple[str, ...], list[str]]:
    """What to read by each header: the export's folder where all its part files agree, else the files. First lines are fetched by several threads."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        listed = list(pool.map(lambda e: part_files(spark, e.path), exports))
        headers = iter(list(pool.map(lambda f: header_of(spark, f), [f for files in listed for f in files])))
    groups: dict[tuple[str, ...], list[str]] = {}
    for export, files in zip(exports, listed, strict=True):
        own = [next(headers) for _ in files]
        for header, path in {own[0]: export.path}.items() if len(set(own)) == 1 else zip(own, files, strict=True):
            groups.setdefault(header, []).append(path)
    return groups


def read_landing(spark: SparkSession, spec: TableSpec, exports: Sequence[Export]) -> DataFrame | None:
    """Rows of the exports as strings, with ``source_file`` and ``ingestion_date``; None if there is no header.

    Each part file is read by its own header, so columns may stand in any order and under another known name. Columns that the table does not know are kept
    by name in ``rescued``. A file that lacks a column or repeats one is kept line by line in ``malformed_row``, with the fault in ``schema_fault``: it is rejected as a whole,
    and the others go on. A line with too few or too many fields keeps its text in ``malformed_row``.
    """
    read = [_read_alike(spark, spec, header, paths) for header, paths in by_header(spark, exports).items() if header]
    return reduce(DataFrame.unionByName, read) if read else None


def header_fault(spec: TableSpec, names: Sequence[str]) -> str | None:
    """Why files with these columns, by their proper names, cannot be read; None if they can."""
    missing = [c for c in spec.landing_columns if c not in names]
    twice = sorted({c for c in names if list(names).count(c) > 1})
    return f"schema:missing {' '.join(missing)}" if missing else f"schema:repeated {' '.join(twice)}" if twice else None


def origin(spec: TableSpec) -> list[Column]:
    """Name and time of the export a row comes from: the file itself carries the name, or else the folder it lies in does."""
    path = F.col("_metadata.file_path")
    file, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    prefix = f"{spec.name}_"
    name = F.when(file.startswith(prefix), file).otherwise(F.substring_index(folder, "=", -1))
    stamp = F.substring(name, len(prefix) + 1, STAMP_LENGTH)
    return [name.alias("source_file"), F.to_timestamp(stamp, STAMP_FORMAT).alias(RAW_PARTITION)]


def _read_alike(spark: SparkSession, spec: TableSpec, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    names = [spec.aliases.get(c, c) for c in header]
    unknown = [c for c in names if c not in spec.landing_columns]
    nothing = F.lit(None).cast("map<string,string>")
    if fault := header_fault(spec, names):
        lines = spark.read.option("recursiveFileLookup", "true").text(paths)
        empty = [F.lit(None).cast("string").alias(c) for c in spec.landing_columns]
        kept = lines.select("value", *origin(spec)).where(F.col("value") != ",".join(header))
        return kept.select(*empty, F.col("value").alias(MALFORMED), "source_file", RAW_PARTITION, nothing.alias(RESCUED), F.lit(fault).alias(SCHEMA_FAULT))
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, MALFORMED]])
    rows = (
        spark.read.options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("multiLine", str(spec.multiline).lower())
        .schema(as_text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("enforceSchema", "false")
        .csv(paths)
    )
    named = dict(zip(names, header, strict=True))
    rescued = F.create_map(*[x for c in unknown for x in (F.lit(c), F.col(f"`{named[c]}`"))]) if unknown else nothing
    known = [F.col(f"`{named[c]}`").alias(c) for c in spec.landing_columns]
    return rows.select(*known, MALFORMED, *origin(spec), rescued.alias(RESCUED), F.lit(None).cast("string").alias(SCHEMA_FAULT))


def raw_table(spec: TableSpec) -> str:
    return f"raw_{spec.name}"


def write_raw(lake: Lake, spec: TableSpec, batch: DataFrame) -> None:
    """Keep the checked batch as landed, with its ``reasons``, by export time.

    Landing an export again replaces its partition. The checks run once, in this write; later steps that only need
    keys and verdicts read those columns.
    """
    text = [T.StructField(c, T.StringType()) for c in [*spec.landing_columns, MALFORMED, "source_file"]]
    verdict = T.StructField(REASONS, T.ArrayType(T.StringType()))
    rescued = T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType()))
    schema = T.StructType([*text, rescued, verdict, T.StructField(RAW_PARTITION, T.TimestampType())])
    lake.ensure(raw_table(spec), schema, partition_by=RAW_PARTITION)
    lake.replace_partitions(raw_table(spec), batch, RAW_PARTITION, rebalance=False)


def read_raw(lake: Lake, spec: TableSpec, since: datetime | str | None = None) -> DataFrame:
    """Raw rows of the exports from ``since`` on; the filter prunes partitions."""
    raw = lake.read(raw_table(spec))
    if since is None:
        return raw
    return raw.where(F.col(RAW_PARTITION) >= F.lit(since).cast("timestamp"))


def latest_export_time(lake: Lake, spec: TableSpec) -> datetime | None:
    """Time of the newest raw partition, from the catalog only."""
    found = lake.partitions(raw_table(spec), RAW_PARTITION)
    return found.agg(F.max(F.col(RAW_PARTITION).cast("timestamp")).alias("latest")).first()["latest"]


def read_latest(lake: Lake, spec: TableSpec) -> DataFrame:
    latest = latest_export_time(lake, spec)
    raw = lake.read(raw_table(spec))
    return raw.where(F.col(RAW_PARTITION) == F.lit(latest).cast("timestamp")) if latest else raw.limit(0)
