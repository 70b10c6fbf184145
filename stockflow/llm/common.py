"""What the operators of this subpackage share: tables, splits, vocabularies and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.session import tune

#: Texts are taken from an Arrow batch in slices of about so many bytes, so that Python objects stay few.
SLICE_BYTES = 2 * 1024 * 1024
#: Arrow batches hold at most so many rows and about so many bytes.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024)}


WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
BESIDE_SPACE = list(dict.fromkeys(pair for c in WHITE for pair in (c + " ", " " + c)))


def single_spaced(text: str) -> bool:
    """Whether every space of a text stands alone between two characters that are not white space. An empty text is not."""
    return bool(text) and not (text[0].isspace() or text[-1].isspace()) and not any(pair in text for pair in BESIDE_SPACE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that bound the memory of Python workers."""
    tune(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast a value of bounded size; ``opened`` gives it back in a task. Its classes travel with it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared: Broadcast) -> object:
    """A worker opens a broadcast once, so what a task leaves in it (memos) is there for the worker's next tasks."""
    if not hasattr(shared, "opened"):
        shared.opened = cloudpickle.loads(shared.value)
    return shared.opened


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def fold(doc_id: Column, n: int) -> Column:
    """Remainder of crc32 of the id's text; ids that are null fall into no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches where the bytes of a text column pass the limit; every row stays, also one that is longer."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        per_row = max(1, batch.column(column).nbytes // batch.num_rows)
        step = max(1, limit // per_row)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_texts(
    docs: DataFrame,
    columns: list[Column],
    schema: str,
    make: Callable[..., Callable[[pa.RecordBatch], dict]],
    *broadcasts: Broadcast,
) -> DataFrame:
    """Apply ``make(*values)(batch) -> columns`` to slices of ``columns``; the text column is called ``text``.

    ``make`` runs once for each task. Memos that it finds in the broadcast values are shared by a worker's tasks.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make(*[opened(b) for b in broadcasts])
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_pydict(step(batch))

    return docs.select(*columns).mapInArrow(run, schema)


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(docs[text_col], F.lit("")).alias("text")


def keep_rows(docs: DataFrame, text_col: str, make: Callable[..., Callable[[list[str]], list[bool]]], *broadcasts: Broadcast) -> DataFrame:
    """The rows whose text ``make(*values)(texts)`` says yes to, with all their columns as they are, also columns of equal names."""
    names = docs.columns
    at = f"c{names.index(text_col)}"
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = make(*[opened(b) for b in broadcasts])
        for batch in slices(batches, at):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(wanted(texts), pa.bool_()))

    return numbered.mapInArrow(run, numbered.schema).toDF(*names)


def one_row_per_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and text; rows without id are left out, and of different texts under one id the greatest stands for it."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).where("doc_id IS NOT NULL")
    if rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows
    return rows.groupBy("doc_id").agg(F.max("text").alias("text"))
