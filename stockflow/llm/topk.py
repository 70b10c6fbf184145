"""Exact top-k by inner product, with bounds from segment statistics at several resolutions.

A vector is cut into segments of length L; each has a mean m and a deviation s (root of the mean squared difference from m). The squared
distance of two vectors is at least the sum over segments of L * ((m1 - m2)^2 + (s1 - s2)^2), and since an inner product is half of
|q|^2 + |x|^2 - distance, it is at most the sum of L * (m1 * m2 + s1 * s2). Few long segments give this bound cheaply, many short ones
tightly. Pairs whose bound stays under the k-th best score so far are left out, coarse resolution first; for the rest the exact integer
product is computed.

Queries are taken in blocks of bounded size; each block is broadcast and meets every row, and each task passes on k rows a query at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.llm.common import opened, prepare, share, table

K = 5
#: Segments at each resolution, coarse to fine.
SEGMENTS = (4, 16)
#: A block of queries holds about so many numbers.
BLOCK_NUMBERS = 4_000_000
#: Rows and queries bounded at once, and pairs computed at once.
FIRST_ROWS, ROWS, QUERIES, PAIRS = 64, 1024, 512, 65_536
#: Above this share of surviving pairs, a tile's products are computed as one product of matrices.
DENSE = 1 / 16
INT64 = np.iinfo(np.int64)


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component; null for vectors that take no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """For each vector the means and deviations of its segments, each times the root of the segment's length."""
    parts = [p for p in np.array_split(np.arange(vectors.shape[1]), segments) if len(p)]
    out = np.empty((len(vectors), 2 * len(parts)))
    for j, p in enumerate(parts):
        own = vectors[:, p]
        out[:, 2 * j] = own.mean(axis=1) * math.sqrt(len(p))
        out[:, 2 * j + 1] = own.std(axis=1) * math.sqrt(len(p))
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise integer products; beyond 64 bits they are computed exactly and then limited to the range of a long."""
    top = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    if top < 2**62:
        return np.einsum("ij,ij->i", a, b)
    exact = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.array([min(max(int(x), INT64.min), INT64.max) for x in exact], np.int64)


class Best:
    """The k best rows so far of each query of a block, and the search of further rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.real = vectors.astype(float)
        self.norms = np.linalg.norm(self.real, axis=1)
        self.features = [segment_features(self.real, s) for s in SEGMENTS]
        self.query, self.row, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.limit = np.full(len(ids), -np.inf)  # the k-th best score
        self.pairs = self.computed = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        begin = 0
        while begin < len(ids):
            end = begin + (ROWS if begin else FIRST_ROWS)  # a few rows first give limits for all others
            own, real = vectors[begin:end], vectors[begin:end].astype(float)
            norms, features = np.linalg.norm(real, axis=1), [segment_features(real, s) for s in SEGMENTS]
            for q in range(0, len(self.ids), QUERIES):
                self.tile(slice(q, q + QUERIES), ids[begin:end], own, real, norms, features)
            begin = end

    def tile(self, block: slice, ids: np.ndarray, vectors: np.ndarray, real: np.ndarray, norms: np.ndarray, features: list[np.ndarray]) -> None:
        limit = self.limit[block, None]
        slack = 1e-9 * np.outer(self.norms[block], norms) + 1e-6  # rounding errors of the bounds stay far under this
        keep = self.ids[block, None] != ids[None, :]
        self.pairs += keep.size
        for own, others in zip(self.features, features, strict=True):
            keep &= own[block] @ others.T + slack >= limit
            if not keep.any():
                return
        rows = np.nonzero(keep.any(axis=0))[0]
        keep = keep[:, rows]
        self.computed += int(keep.sum())
        small = float(np.abs(self.real[block]).max(initial=0)) * float(np.abs(real).max(initial=0)) * real.shape[1] < 2**53
        if small and keep.mean() > DENSE:
            score = self.real[block] @ real[rows].T  # sums of products under 2^53 are exact
            q, r = np.nonzero(keep & (score >= limit))
            found = score[q, r].astype(np.int64)
        else:
            q, r = np.nonzero(keep)
            found = np.concatenate([np.empty(0, np.int64), *[exact_products(self.vectors[block][q[i : i + PAIRS]], vectors[rows[r[i : i + PAIRS]]]) for i in range(0, len(q), PAIRS)]])
        if len(q):
            self.merge(q + block.start, ids[rows[r]], found)

    def merge(self, query: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        query, row, score = (np.concatenate(x) for x in ((self.query, query), (self.row, row), (self.score, score)))
        order = np.lexsort((row, -score.astype(float) if score.size and score.min() == INT64.min else -score, query))
        query, row, score = query[order], row[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        self.query, self.row, self.score = (x[rank < self.k] for x in (query, row, score))
        full = rank == self.k - 1
        self.limit[query[full]] = score[full]


def by_length(ids: pa.Array, vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrices of the vectors of each length."""
    lengths = np.asarray(vectors.value_lengths())
    numbers, flat = np.asarray(ids), np.asarray(vectors.flatten())
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        own = np.nonzero(lengths == length)[0]
        yield numbers[own], flat[starts[own][:, None] + np.arange(length)[None, :]]


def top_products(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer product for each row that ``queries`` selects.

    A query meets all rows of other ids whose vectors are as long as its own. Null vectors, vectors that hold null or
    non-finite components, and rows without id take no part. Ties go to the smaller id. A row that repeats a candidate counts once more; a repeated query
    counts once. Other columns are not read.
    """
    spark = vectors.sparkSession
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"), queries.alias("asks")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    size = usable.where("asks").agg(F.sum(F.size("v") + 1)).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_numbers))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    found = None
    for b in range(n_blocks):
        taken = usable.where(F.col("asks") & (block == b)).select("vec_id", "v").dropDuplicates(["vec_id"]).toArrow().combine_chunks()
        parts = {m.shape[1]: (i, m) for chunk in taken.to_batches() for i, m in by_length(chunk.column(0), chunk.column(1))}
        shared = share(spark, parts)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = {length: Best(ids, matrix, k) for length, (ids, matrix) in opened(shared).items()}
            for batch in batches:
                for ids, matrix in by_length(batch.column(0), batch.column(1)):
                    if matrix.shape[1] in best:
                        best[matrix.shape[1]].add(ids, matrix)
            for own in best.values():
                yield pa.RecordBatch.from_pydict({"query_id": own.ids[own.query], "vec_id": own.row, "score": own.score})

        part = usable.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
