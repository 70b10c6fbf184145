"""Whitening of embeddings by a bidiagonal qd solver.

Centred rows are reduced to a triangular R by QR, block after block in each task and then in a tree over the tasks, so R'R is their scatter matrix, which is
never formed. Householder reflections make R a bidiagonal B. The dqds algorithm finds the squares of B's singular values, each to high relative accuracy;
a twisted factorisation of B'B less each of them gives its vector, and the reflections carry the vectors back to the directions of the components.

Sums over rows are exact: numbers are integers, and their sums are decimals of 38 digits. Centring subtracts the integer part of the mean first, so
nothing is lost to the numbers' offset. What passes through the driver is bounded by the square of the dimension.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.lake import materialise
from stockflow.llm.common import opened, prepare, share, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Larger entries are cut to this, so that they stay integers that a double holds exactly.
LIMIT = 2**50
#: R factors that one task of the tree joins.
JOINED = 16
EPS = float(np.finfo(float).eps)
#: An off-diagonal entry of the qd array is nothing beside a value that is so much larger.
TOLERANCE = (10 * EPS) ** 2
#: Vectors of values closer than this, relative to the larger, are made orthogonal to each other.
CLUSTER = 1e-3
#: Directions whose deviation is less than this share of the largest one have no variance.
RANK = 1e-12
INT64 = np.iinfo(np.int64)
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B, and W, where r = U B W' with orthogonal U (not kept) and W, by Householder reflections."""
    size = r.shape[1]
    a = np.concatenate([r, np.zeros((max(0, size - len(r)), size))])
    w = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        top = np.abs(x).max(initial=0.0)
        if top == 0 or not np.any(x[1:]):
            return None
        v = x / top
        v[0] += math.copysign(float(np.linalg.norm(v)), v[0])
        return v / np.linalg.norm(v)

    for k in range(size):
        left = reflector(a[k:, k])
        if left is not None:
            a[k:, k:] -= 2 * np.outer(left, left @ a[k:, k:])
        right = reflector(a[k, k + 1 :])
        if right is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ right, right)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ right, right)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference transform: the qd array of values less ``shift``; None if that was above the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for ahead, off in zip(q[1:], e, strict=True):
        if d < 0:
            return None
        pivot = d + off
        ratio = ahead / pivot
        new_q.append(pivot)
        new_e.append(off * ratio)
        d = d * ratio - shift
    return ([*new_q, d], new_e) if d >= 0 else None


def lower_bound(q: list[float], e: list[float]) -> float:
    """No value is below this: the inverse of the trace of the inverse, whose diagonal an unshifted transform passes by."""
    d = q[0]
    inverse = 1 / d if d else math.inf
    for ahead, off in zip(q[1:], e, strict=True):
        d *= ahead / (d + off)
        inverse += 1 / d if d else math.inf
    return 1 / inverse


def qd_values(q: Iterable[float], e: Iterable[float]) -> np.ndarray:
    """The squared singular values of a bidiagonal, largest first, from the squares of its diagonal and its upper diagonal.

    Arrays are cut where an off-diagonal entry is negligible; the values found at the end of one are what was shifted so far plus the last entry. Shifts never
    pass the smallest value but by rounding; then the transform shows a negative pivot and is done again with less.
    """
    found = []
    open_parts = [(list(map(float, q)), list(map(float, e)), 0.0)]
    while open_parts:
        q, e, moved = open_parts.pop()
        cut = next((k for k in reversed(range(len(e))) if e[k] <= TOLERANCE * (moved + min(q[k], q[k + 1]))), None)
        if cut is not None:
            open_parts += [(q[: cut + 1], e[:cut], moved), (q[cut + 1 :], e[cut + 1 :], moved)]
            continue
        if len(q) <= 1:
            found += [v + moved for v in q]
            continue
        if 1.5 * q[0] < q[-1]:  # small entries belong at the end, where they are deflated
            q, e = q[::-1], e[::-1]
        shift = lower_bound(q, e)
        if shift <= EPS * moved:
            shift = 0.0
        step = dqds(q, e, shift)
        while step is None:
            shift = shift * (1 - 1e-6) if shift > 0.99 * lower_bound(q, e) else shift / 2
            shift = shift if shift > EPS * moved else 0.0
            step = dqds(q, e, shift)
        open_parts.append((*step, moved + shift))
    return np.sort(np.array(found))[::-1]


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """The vector of B'B at ``value``.

    B'B - value is factored from the top by the stationary qd transform and from the bottom by the progressive one, both on B's own entries. They are joined where
    the twist is smallest; from there each entry of the vector is a product.
    """
    n = len(diagonal)
    q, e, off = diagonal**2, upper**2, diagonal[:-1] * upper
    least = max(float(q.max(initial=0)), float(e.max(initial=0))) * EPS * EPS + np.finfo(float).tiny
    down, up, s, p = np.zeros(n - 1), np.zeros(n - 1), np.empty(n), np.empty(n)
    s[0], p[-1] = -value, q[-1] - value
    for k in range(n - 1):
        pivot = q[k] + s[k]
        pivot = pivot if abs(pivot) > least else math.copysign(least, pivot)
        down[k] = off[k] / pivot
        s[k + 1] = e[k] * (s[k] / pivot) - value
    for k in reversed(range(n - 1)):
        pivot = e[k] + p[k + 1]
        pivot = pivot if abs(pivot) > least else math.copysign(least, pivot)
        up[k] = off[k] / pivot
        p[k] = q[k] * (p[k + 1] / pivot) - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in reversed(range(twist)):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    z /= np.abs(z).max()
    return z / np.linalg.norm(z)


def inverse_step(diagonal: np.ndarray, upper: np.ndarray, value: float, b: np.ndarray) -> np.ndarray:
    """x with (B'B - value) x = b, by elimination with exchange of rows."""
    n = len(diagonal)
    main, low = diagonal**2 - value, diagonal[:-1] * upper
    main[1:] += upper**2
    up, far, x = np.append(low, 0.0), np.zeros(n), b.copy()
    least = EPS * float(np.abs(main).max() + 2 * np.abs(low).max(initial=0)) + np.finfo(float).tiny
    low = low.copy()
    for k in range(n - 1):
        if abs(low[k]) > abs(main[k]):
            main[k], low[k] = low[k], main[k]
            up[k], main[k + 1] = main[k + 1], up[k]
            far[k], up[k + 1] = up[k + 1], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        main[k] = main[k] if abs(main[k]) > least * EPS else least
        m = low[k] / main[k]
        main[k + 1] -= m * up[k]
        up[k + 1] -= m * far[k]
        x[k + 1] -= m * x[k]
    main[-1] = main[-1] if abs(main[-1]) > least * EPS else least
    for k in reversed(range(n)):
        x[k] = (x[k] - (up[k] * x[k + 1] if k + 1 < n else 0.0) - (far[k] * x[k + 2] if k + 2 < n else 0.0)) / main[k]
    return x / np.linalg.norm(x)


def vectors_of_block(diagonal: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, largest first, and vectors (as columns) of B'B for a bidiagonal whose upper diagonal has no zero.

    Vectors of values that lie close together are made orthogonal; where a twisted factorisation gives a vector that is already there,
    as for values equal to the last bit, steps of inverse iteration find another.
    """
    values = qd_values(diagonal**2, upper**2)
    out = np.zeros((len(values), len(values)))
    start = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * values[k - 1]:
            start = k
        z, near = twisted_vector(diagonal, upper, value), out[:, start:k]
        for attempt in range(6):
            before = z.copy()
            for _ in range(2):
                z = z - near @ (near.T @ z)
            size = np.linalg.norm(z)
            if size > 0.1 and np.isfinite(size):
                z /= size
                break
            fresh = np.cos((1.0 + attempt + k) * np.arange(1, len(values) + 1)) if attempt % 3 == 0 else before
            fresh = fresh - near @ (near.T @ fresh)
            z = inverse_step(diagonal, upper, value, fresh / np.linalg.norm(fresh))
        else:  # values equal to the last bit: any direction that is left will do
            left = np.eye(len(values)) - near @ near.T
            z = left[:, int(np.argmax(np.diag(left)))]
            z = z - near @ (near.T @ z)
            z /= np.linalg.norm(z)
        out[:, k] = z
    return values, out


def principal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of r'r, largest first, and unit eigenvectors as columns."""
    diagonal, upper, w = bidiagonal(r)
    size = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(upper).max(initial=0)))
    upper = np.where(np.abs(upper) <= 2 * EPS * math.sqrt(len(diagonal)) * size, 0.0, upper)
    ends = [*np.nonzero(upper == 0)[0].tolist(), len(diagonal) - 1]
    values, vectors, begin = [], [], 0
    for end in ends:
        own, z = vectors_of_block(diagonal[begin : end + 1], upper[begin:end])
        whole = np.zeros((len(diagonal), len(own)))
        whole[begin : end + 1] = z
        values.append(own)
        vectors.append(whole)
        begin = end + 1
    value, vector = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-value, kind="stable")
    return value[order], w @ vector[:, order]


def finite(vector: Column) -> Column:
    """Whether a vector is not null and holds neither nulls nor non-finite entries."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def integers(vectors: pa.ListArray, size: int) -> np.ndarray:
    """floor(64 * entry) + 1000000 for a batch of vectors of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(-1, size) + SHIFT


class Centre:
    """n, the sums by dimension, and rows less the mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.size = n, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]  # n * (x - whole) - rest is n * x - sum
        self.part = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.part

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - sum) squared, exactly; limited to the range of a long."""
        y = x - self.whole
        top = int(np.abs(y).max(initial=0)) + 1
        if (self.n * top) ** 2 * self.size < INT64.max:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1)
        n, rest = self.n, np.array(self.rest, object)
        small = top * top * self.size < INT64.max and top * self.n * self.size < INT64.max
        squares = (y * y).sum(axis=1).tolist() if small else (y.astype(object) ** 2).sum(axis=1).tolist()
        mixed = (y @ rest.astype(np.int64)).tolist() if small else (y.astype(object) @ rest).tolist()
        constant = sum(int(r) ** 2 for r in self.rest)
        return np.array([min(n * n * s - 2 * n * m + constant, INT64.max) for s, m in zip(squares, mixed, strict=True)], np.int64)


def map_vectors(rows: DataFrame, size: int, schema: str, make: Callable[[], tuple[Callable[[pa.Array, np.ndarray], pa.RecordBatch | None], Callable[[], pa.RecordBatch | None]]]) -> DataFrame:
    """Apply ``step(ids, integers)`` to every batch of a task and ``end()`` after the last; each may give a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, end = make()
        for batch in batches:
            if batch.num_rows and (out := step(batch.column(0), integers(batch.column(1), size))) is not None:
                yield out
        if (out := end()) is not None:
            yield out

    return rows.mapInArrow(run, schema)


def summed(rows: DataFrame, size: int) -> Centre:
    """Exact sums of every dimension; each task passes on one row for each."""

    def make():
        total = [0] * size
        n = [0]

        def step(_: pa.Array, x: np.ndarray) -> None:
            n[0] += len(x)
            total[:] = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]

        def end() -> pa.RecordBatch:
            values = pa.array([Decimal(v) for v in [*total, n[0]]], pa.decimal128(38, 0))
            return pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), values], ["dimension", "total"])

        return step, end

    parts = map_vectors(rows, size, "dimension int, total decimal(38,0)", make)
    found = dict(parts.groupBy("dimension").agg(F.sum("total").cast("decimal(38,0)")).collect())
    return Centre(int(found[size]), [int(found[k]) for k in range(size)])


def triangular(rows: DataFrame, size: int, centre: Centre) -> np.ndarray:
    """R of the QR factorisation of all centred rows: by blocks in each task, then joined in a tree."""
    shared = share(rows.sparkSession, centre)

    def make():
        own, held = opened(shared), [np.zeros((0, size))]

        def step(_: pa.Array, x: np.ndarray) -> None:
            held[0] = np.linalg.qr(np.concatenate([held[0], own.centred(x)]), mode="r")

        def end() -> pa.RecordBatch:
            part = TaskContext.get().partitionId()
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "r": pa.array([held[0].tobytes()], pa.binary())})

        return step, end

    def join(parts: pd.DataFrame) -> pd.DataFrame:
        stacked = np.concatenate([np.frombuffer(r).reshape(-1, size) for r in parts.sort_values("part")["r"]])
        return pd.DataFrame({"part": [int(parts["part"].iloc[0]) // JOINED], "r": [np.linalg.qr(stacked, mode="r").tobytes()]})

    factors = materialise(map_vectors(rows, size, "part long, r binary", make), "qr")
    last = factors.agg(F.max("part")).first()[0]
    while last > 0:
        factors = materialise(factors.groupBy(F.floor(F.col("part") / JOINED).alias("group")).applyInPandas(join, "part long, r binary"), "qr")
        last //= JOINED
    return np.frombuffer(factors.first()["r"]).reshape(-1, size)


def identity_error(rows: DataFrame, size: int, centre: Centre, directions: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity; tasks pass on one row for each entry."""
    k = directions.shape[1]
    shared = share(rows.sparkSession, (centre, directions))

    def make():
        (own, to), products, totals = opened(shared), np.zeros((k, k)), np.zeros(k)

        def step(_: pa.Array, x: np.ndarray) -> None:
            white = own.centred(x) @ to
            products[:] += white.T @ white
            totals[:] += white.sum(axis=0)

        def end() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"entry": pa.array(range(k * k + k), pa.int32()), "total": np.concatenate([products.ravel(), totals])})

        return step, end

    found = dict(map_vectors(rows, size, "entry int, total double", make).groupBy("entry").agg(F.sum("total")).collect())
    total = np.array([found[i] for i in range(k * k + k)]) / centre.n
    covariance = total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :])
    return float(np.abs(covariance - np.eye(k)).max(initial=0))


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries take no part; of those left, the vectors of the most common length do (the longer, of lengths equally common). Rows
    without id, or that repeat an id or a vector, are rows like others. Directions without variance are no components, so equal vectors, a single one, empty ones
    and an empty table give no rows. Entries beyond 2^50 / 64 are cut to that, and a deviation beyond a long to the largest long. Other columns are not read.
    """
    spark = vectors.sparkSession
    v = vectors[vector_col]
    usable = vectors.where(finite(v)).select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v"))
    found = usable.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if found is None or found["size"] == 0:
        return spark.createDataFrame([], WHITENED)
    size = found["size"]
    rows = usable.where(F.size("v") == size)
    centre = summed(rows, size)
    r = triangular(rows, size, centre)
    values, axes = principal(r)
    values = np.maximum(values, 0.0) / centre.n
    kept = np.sqrt(values) > RANK * math.sqrt(values[0])
    kept &= np.arange(size) < components
    if not kept.any():
        return spark.createDataFrame([], WHITENED)
    explained = values[kept] / values.sum()
    directions = axes[:, kept] / np.sqrt(values[kept])
    error = identity_error(rows, size, centre, directions)
    shared = share(spark, (centre, directions, explained, error))

    def make():
        own, to, explained, error = opened(shared)
        k = to.shape[1]

        def step(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
            n = len(x)
            each = np.repeat(np.arange(n), k)
            columns = {
                "vec_id": ids.take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                "n": pa.array(np.full(n * k, own.n, np.int64)),
                "deviation": pa.array(own.deviation(x)[each]),
                "whitened": pa.array((own.centred(x) @ to).ravel()),
                "explained": pa.array(np.tile(explained, n)),
                "identity_error": pa.array(np.full(n * k, error)),
            }
            return pa.RecordBatch.from_pydict(columns)

        return step, lambda: None

    return map_vectors(rows, size, WHITENED, make)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(prepare(spark), sf_dir, "embeddings"))
