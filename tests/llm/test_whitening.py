from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import folder  # noqa: F401
from ledgerloom.llm import registry, whitening
from ledgerloom.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, component int, whitened double, x long"


def run(spark, scratch, rows, **options):
    df = spark.createDataFrame([(i, v, 7, 0.5, 1) for i, v in rows], SCHEMA)
    return whitening.whitened(
        df, F.col("vec_id"), F.col("embedding"), scratch.keep, **options
    ).collect()


@pytest.mark.parametrize("kind", ["random", "low rank", "repeated", "diagonal", "close", "zero"])
@pytest.mark.parametrize("n", [1, 2, 7, 33])
def test_components_against_dense_solver(kind, n):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    spectrum = {
        "random": rng.exponential(1e5, n),
        "low rank": np.where(np.arange(n) < n // 3 + 1, rng.exponential(9.0, n), 0),
        "repeated": np.where(np.arange(n) < n // 2, 5.0, 2.0),
        "diagonal": rng.integers(1, 4, n).astype(float),
        "close": 1e6 * (1 + 1e-9 * np.arange(n)),
        "zero": np.zeros(n),
    }[kind]
    a = np.diag(spectrum) if kind == "diagonal" else q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.components(a, 8)
    size = max(np.linalg.norm(a), 1e-300)
    expected = np.linalg.eigvalsh(a)[::-1][:8]
    assert len(values) == min(n, 8)
    assert np.abs(values - expected).max() < 1e-13 * size
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(20, 20))
    a += a.T
    values, vectors = np.linalg.eigh(a)
    sign = vectors @ np.diag(np.sign(values)) @ vectors.T
    assert np.abs(whitening.polar_factor(a) - sign).max() < 1e-12


def test_whole_query_against_brute_force(spark, folder):
    rows = {r.vec_id: r.embedding for r in table(spark, folder, "embeddings").collect()}
    ids = sorted(
        i for i, v in rows.items()
        if v and all(e is not None and math.isfinite(e) for e in v)
    )
    x = np.array([[math.floor(1024 * float(e)) + 100_000 for e in rows[i]] for i in ids])
    n, s = len(x), x.sum(0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = registry.op12_whitening(spark, folder).collect()
    assert len(got) == 8 * n
    of = {(r.vec_id, r.component): r for r in got}
    for k in range(8):
        expected = centred @ vectors[:, k] / np.sqrt(values[k])
        found = np.array([of[i, k + 1].whitened for i in ids])
        if expected @ found < 0:
            expected = -expected
        assert np.abs(found - expected).max() < 1e-8
        assert abs(of[ids[0], k + 1].explained - values[k] / values.sum()) < 1e-12
    for i, row in zip(ids, x.tolist()):
        assert of[i, 1].deviation == sum((n * e - int(t)) ** 2 for e, t in zip(row, s))
        assert of[i, 1].n == n
    assert max(r.identity_error for r in got) < 1e-10


def test_odd_rows_take_no_part(spark, scratch):
    good = [(i, [i * 0.25, (i * i) % 7 * 1.0]) for i in range(12)]
    odd = [
        (90, None), (91, []), (92, [1.0, None]), (93, [1.0, float("nan")]),
        (94, [float("inf"), 1.0]), (95, [1.0]), (96, [1e300, 1.0]),
    ]
    got = run(spark, scratch, good + odd + [good[3], (None, [0.5, 2.0])])
    assert {r.vec_id for r in got} == set(range(12)) | {None}
    assert {r.n for r in got} == {14}
    assert sum(r.vec_id == 3 for r in got) == 4  # a repeated row counts twice
    assert {r.component for r in got} == {1, 2}
    w = np.array([[r.whitened for r in got if r.component == k] for k in (1, 2)])
    assert np.abs(w @ w.T / 14 - np.eye(2)).max() < 1e-12


def test_without_spread_or_rows(spark, scratch):
    assert run(spark, scratch, []) == []
    assert run(spark, scratch, [(1, [1.0, 2.0])]) == []
    assert run(spark, scratch, [(i, [1.0, 2.0]) for i in range(5)]) == []
    # One dimension varies, the other does not: one component.
    got = run(spark, scratch, [(i, [1.0, float(i)]) for i in range(5)])
    assert {r.component for r in got} == {1} and len(got) == 5
    assert abs(got[0].explained - 1) < 1e-12


def test_deviation_beyond_64_bits(spark, scratch):
    got = run(spark, scratch, [(0, [0.0]), (1, [2.0**40]), (2, [3.0])])
    x = [100_000, 2**50 + 100_000, 3 * 1024 + 100_000]
    assert {r.vec_id: int(r.deviation) for r in got} == {
        i: (3 * e - sum(x)) ** 2 for i, e in enumerate(x)
    }


def test_rows_do_not_depend_on_partitions(spark, scratch):
    rows = [(i, [math.sin(i), math.cos(3 * i), i % 5 * 0.1]) for i in range(300)]
    one = sorted(map(tuple, run(spark, scratch, rows)))
    other = sorted(map(tuple, run(spark, scratch, rows[::-1])))
    assert [r[:4] for r in one] == [r[:4] for r in other]
    assert np.allclose([r[4] for r in one], [r[4] for r in other], atol=1e-14)
