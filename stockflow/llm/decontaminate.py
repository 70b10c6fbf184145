"""Benchmark passages in documents, found by the Wu-Manber method over words.

Patterns are windows of ``WINDOW`` consecutive words of a benchmark item; a shorter item is one pattern. Patterns of one length m share
a table of blocks of two words (one, if m is 1): how far a search may move on when this block ends at the current word. A block
that no pattern holds allows m - 1 words at once; a block that ends a pattern allows none, and then the bucket of that block
gives the patterns to compare word for word.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import keep_rows, opened, prepare, share, slices, table

WINDOW = 10
#: Benchmarks are broadcast in parts of about so many characters; documents go through one part after the other.
PART_CHARS = 8_000_000
#: Upper case A-Z to lower case, and every ASCII character that belongs to no word to a space.
WORDS_ONLY = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

Pattern = tuple[bytes, ...]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORDS_ONLY).split()


def patterns_of(items: Iterable[tuple[int | None, str | None]], window: int = WINDOW) -> dict[Pattern, set[int]]:
    """Patterns with the ids of the items they come from."""
    found: dict[Pattern, set[int]] = {}
    for item_id, text in items:
        words = words_of(text or "")
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[i : i + window]), set()).update([] if item_id is None else [item_id])
    return found


class Table:
    """Shifts and buckets of the patterns of one length."""

    def __init__(self, length: int, patterns: dict[Pattern, set[int]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, dict[Pattern, set[int]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = b" ".join(pattern[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.bucket.setdefault(key, {})[pattern] = items

    def search(self, words: list[bytes], hit: bytearray, items: set[int]) -> None:
        """Mark the words of every occurrence in ``hit`` and add its items."""
        shift, far, m, n = self.shift, self.far, self.length, len(words)
        at = m - 1
        while at < n:
            key = words[at - 1] + b" " + words[at] if self.block == 2 else words[at]
            move = shift.get(key, far)
            if move:
                at += move
                continue
            found = self.bucket[key].get(tuple(words[at - m + 1 : at + 1]))
            if found is not None:
                hit[at - m + 1 : at + 1] = b"\1" * m
                items |= found
            at += 1


class Matcher:
    def __init__(self, patterns: dict[Pattern, set[int]]):
        by_length: dict[int, dict[Pattern, set[int]]] = {}
        for pattern, items in patterns.items():
            by_length.setdefault(len(pattern), {})[pattern] = items
        self.tables = [Table(length, own) for length, own in sorted(by_length.items())]

    def search(self, words: list[bytes]) -> tuple[bytearray, set[int]]:
        hit, items = bytearray(len(words)), set()
        for t in self.tables:
            t.search(words, hit, items)
        return hit, items


def spans_of(hit: bytearray) -> list[tuple[int, int]]:
    """Runs of hit words as (first, one after the last)."""
    spans, begin = [], hit.find(1)
    while begin >= 0:
        end = hit.find(0, begin)
        end = len(hit) if end < 0 else end
        spans.append((begin, end))
        begin = hit.find(1, end)
    return spans


def benchmark_parts(benchmark: DataFrame, id_col: str, text_col: str, window: int, part_chars: int) -> list[Matcher]:
    """Matchers of bounded size. Rows of one id stay in one part; a single item larger than a part is a part of its own."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / part_chars))
    part = F.pmod(F.xxhash64("item_id"), F.lit(n))
    return [Matcher(patterns_of(rows.where(part == k).toLocalIterator(), window)) for k in range(n)]


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """For each row: doc_id, n_words, ``spans`` of hit words, and ``items``, the ids whose passages occur, ascending.

    A null or empty text has no words. Rows are independent of each other. An item without id marks words but is not listed; an empty
    benchmark hits nothing. Other columns are not read.
    """
    spark = docs.sparkSession
    schema = "doc_id long, text string, n_words long, spans array<struct<begin:long,end:long>>, items array<long>"
    found = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    nothing = F.array().cast("array<struct<begin:long,end:long>>").alias("spans"), F.array().cast("array<long>").alias("items")
    found = found.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"), *nothing)
    matchers = benchmark_parts(benchmark, item_col, "text", window, part_chars)
    types = {"doc_id": pa.int64(), "text": pa.string(), "n_words": pa.int64(), "spans": pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), "items": pa.list_(pa.int64())}
    for k, matcher in enumerate(matchers):
        shared, last = share(spark, matcher), k == len(matchers) - 1

        def run(batches, shared=shared, last=last):
            own = opened(shared)
            for batch in slices(batches, "text"):
                out = {name: batch.column(name).to_pylist() for name in types}
                for i, text in enumerate(out["text"]):
                    words = words_of(text)
                    hit, items = own.search(words)
                    if out["spans"][i]:
                        for span in out["spans"][i]:
                            hit[span["begin"] : span["end"]] = b"\1" * (span["end"] - span["begin"])
                    out["n_words"][i] = len(words)
                    out["spans"][i] = [{"begin": a, "end": b} for a, b in spans_of(hit)]
                    out["items"][i] = sorted(items.union(out["items"][i]))
                if last:
                    out["text"] = [None] * len(out["text"])
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in types.items()], names=list(types))

        found = found.mapInArrow(run, schema)
    return found.drop("text")


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage occurs, with all their columns."""

    def make(matcher: Matcher):
        return lambda texts: [not any(matcher.search(words_of(text))[0]) for text in texts]

    for matcher in benchmark_parts(benchmark, item_col, "text", window, part_chars):
        docs = keep_rows(docs, text_col, make, share(docs.sparkSession, matcher))
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP6_SQL = """
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
lengths AS (SELECT DISTINCT len(p) AS m FROM windows),
places AS (
  SELECT doc_id, i, list_slice(w, i, i + m - 1) AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc_words, lengths WHERE len(w) >= m)),
found AS (SELECT doc_id, i, len(p) AS m, item_id FROM places JOIN windows USING (p)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM found GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
