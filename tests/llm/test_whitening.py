"""Whitening against a dense eigen-decomposition and exact integer sums."""

import math

import numpy as np
import pytest

from stockflow.llm import whitening
from stockflow.llm.common import prepare, table
from tests.llm.common import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, n long, size int, v string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return prepare(spark).createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def integers(vectors) -> list[list[int]]:
    return [[math.floor(64 * float(x)) + 1_000_000 for x in v] for v in vectors]


def check(rows, x: list[list[int]], components: int):
    """Rows by (vec_id, component), vectors numbered as in ``x``."""
    n, size = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(rows) == n * components
    white = np.full((n, components), np.nan)
    for r in rows:
        white[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == min(deviation[r.vec_id], 2**63 - 1)
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert 0 <= r.identity_error <= 1e-4
    assert np.abs(white.T @ white / n - np.eye(components)).max() < 1e-8
    for k in range(components):
        if size == 1 or min(abs(values[k] - values[j]) for j in range(size) if j != k) > 1e-6 * values[0]:
            want = centred @ axes[:, k] / math.sqrt(values[k])
            assert np.abs(np.abs(white[:, k]) - np.abs(want)).max() < 1e-7
            assert abs(abs(want @ white[:, k]) / n - 1) < 1e-9


def test_whole_table(spark):
    rows = table(prepare(spark), SF_DIR, "embeddings").collect()
    place = {r.vec_id: i for i, r in enumerate(rows)}
    class Row:
        def __init__(self, r):
            self.vec_id, self.component, self.n, self.deviation, self.whitened, self.explained, self.identity_error = (place[r.vec_id], *r[1:])

    check([Row(r) for r in whitening.op13_whitening(spark, SF_DIR).collect()], integers([r.embedding for r in rows]), 32)


@pytest.mark.parametrize("case", ["few dimensions", "one dimension", "copies", "dependent", "far apart"])
def test_small_tables(case, spark):
    rng = np.random.default_rng(4)
    kept = 5
    if case == "few dimensions":
        vectors = rng.normal(size=(200, 5))
    elif case == "one dimension":
        vectors, kept = rng.normal(size=(50, 1)), 1
    elif case == "copies":
        vectors = np.concatenate([rng.normal(size=(60, 5)), np.ones((200, 5))])
    elif case == "dependent":
        vectors = np.floor(rng.normal(size=(200, 4)) * 640) / 64
        vectors = np.concatenate([vectors, vectors[:, :1], np.full((200, 1), 3.0)], axis=1)
        kept = 4
    else:
        vectors = rng.normal(size=(100, 5)) * [1e6, 1e4, 1.0, 1.0, 1.0]
    vectors = vectors.astype(np.float32)
    check(whitening.whiten(frame(spark, vectors)).collect(), integers(vectors), kept)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(40, 4)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan")] * 4, [1.0, 2.0, float("inf"), 0.0], [1.0, 2.0]]
    ids = [*range(40), 100, 101, 102, 103, 104, 105]
    found = whitening.whiten(frame(spark, good + bad, ids)).collect()
    check(found, integers(good), 4)
    again = whitening.whiten(frame(spark, good, [None, 7, 7, *range(3, 40)])).collect()
    assert len(again) == 160 and sum(r.vec_id == 7 for r in again) == 12 and sum(r.vec_id is None for r in again) == 4


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[], []]])
def test_nothing_to_whiten(vectors, spark):
    assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_fewer_rows_than_dimensions(spark):
    vectors = np.random.default_rng(6).normal(size=(6, 20)).astype(np.float32)
    check(whitening.whiten(frame(spark, vectors)).collect(), integers(vectors), 5)


def test_large_sums_are_exact():
    big = whitening.Centre(10**9, [3 * 10**15 + 7, 10**15 + 1])
    x = np.array([[3_000_100, 1_000_000], [2_999_000, 1_002_000]], np.int64)
    want = [sum((10**9 * int(a) - s) ** 2 for a, s in zip(row, [3 * 10**15 + 7, 10**15 + 1], strict=True)) for row in x.tolist()]
    assert big.deviation(x).tolist() == [min(w, 2**63 - 1) for w in want]


@pytest.mark.parametrize(
    "rows",
    [
        np.random.default_rng(0).normal(size=(300, 24)),
        np.random.default_rng(1).normal(size=(300, 24)) * np.logspace(0, -6, 24),
        np.random.default_rng(2).normal(size=(300, 24)) * np.logspace(-6, 0, 24),
        np.random.default_rng(3).normal(size=(300, 24)) * np.repeat([1.0, 1.0 + 1e-9, 2.0], 8),
        np.concatenate([np.eye(24), np.eye(24)]),
        np.ones((5, 24)),
        np.random.default_rng(4).normal(size=(7, 24)),
    ],
    ids=["random", "graded", "graded up", "clusters", "equal", "rank one", "few rows"],
)
def test_solver_gives_singular_values_and_vectors(rows):
    values, axes = whitening.principal(np.linalg.qr(rows, mode="r"))
    want = np.zeros(24)
    singular = np.linalg.svd(rows, compute_uv=False)
    want[: len(singular)] = singular
    assert np.abs(np.sqrt(values) - want).max() < 1e-13 * want[0]
    assert np.abs(axes.T @ axes - np.eye(24)).max() < 1e-11
    assert np.abs(rows.T @ rows @ axes - axes * values).max() < 1e-13 * want[0] ** 2 * 24


def test_qd_values_keep_relative_accuracy():
    """A graded bidiagonal whose small values a dense solver of the Gram matrix would lose."""
    diagonal, upper = 10.0 ** -np.arange(12), 10.0 ** -(np.arange(11) + 1.5)
    values = np.sqrt(whitening.qd_values(diagonal**2, upper**2))
    assert np.prod(values) == pytest.approx(np.prod(diagonal), rel=1e-12)
    for value, entry in zip(values, diagonal, strict=True):
        assert value == pytest.approx(entry, rel=0.3)
