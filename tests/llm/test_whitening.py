"""Whitening: rank-one updates and their merging against full eigendecompositions, the query against NumPy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import whitening
from creditloom.llm.whitening import Spectrum, rank_one


def check_spectrum(own, rows):
    scatter = (rows - rows.mean(0)).T @ (rows - rows.mean(0))
    size = max(1.0, np.abs(scatter).max())
    assert own.n == len(rows)
    assert np.allclose(own.mean, rows.mean(0), atol=1e-9 * max(1, np.abs(rows).max()))
    assert np.allclose(own.basis.T @ own.basis, np.eye(rows.shape[1]), atol=1e-9)
    assert np.allclose((own.basis * own.values) @ own.basis.T, scatter, atol=1e-9 * size)
    assert np.all(np.diff(own.values) >= 0)


@given(st.integers(0, 10_000), st.integers(1, 9), st.integers(1, 40), st.sampled_from(["free", "ties", "flat", "same", "wide"]))
@settings(max_examples=150, deadline=None)
def test_spectrum_of_any_rows(seed, dims, n, kind):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dims))
    if kind == "ties":
        rows = np.round(rows)
    elif kind == "flat":
        rows[:, rng.integers(dims)] = 3.0
    elif kind == "same":
        rows[:] = rows[0]
    elif kind == "wide":
        rows *= 10.0 ** rng.integers(-4, 5, size=dims)
    own = Spectrum(dims)
    own.add(rows)
    check_spectrum(own, rows)


def test_update_with_equal_eigenvalues_and_empty_terms():
    values, basis = rank_one(np.ones(4), np.eye(4), np.array([0.0, 3.0, 4.0, 0.0]))
    assert np.allclose(values, [1, 1, 1, 26])
    again = rank_one(values, basis, np.zeros(4))
    assert np.allclose(again[0], values)
    assert np.allclose((basis * values) @ basis.T, np.eye(4) + np.outer([0, 3, 4, 0], [0, 3, 4, 0]))


def test_joined_spectra_equal_one(monkeypatch):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(900, 24)) @ rng.normal(size=(24, 24)) + 50
    monkeypatch.setattr(whitening, "BLOCK", 64)
    total = Spectrum(24)
    for part in np.array_split(rows, [0, 1, 7, 300, 650]):
        own = Spectrum(24)
        own.add(part)
        total.join(Spectrum.unpacked(own.packed(), 24))
    check_spectrum(total, rows)


# --- the query

FIELDS = "vec_id long, embedding array<float>, n string, component string, x string"


def brute(rows, components=16):
    """(id, component) -> figures, from the whole covariance."""
    x = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=np.int64)
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, v in x:
        deviation = sum((n * e - int(s)) ** 2 for e, s in zip(v, total))
        for k in range(min(components, int((values > 1e-12 * values[0]).sum()))):
            out.append((i, k + 1, n, deviation, float((np.array(v) - total / n) @ vectors[:, k] / np.sqrt(values[k])),
                        values[k] / np.trace(cov)))
    return out


def compare(spark, rows, given=None, **how):
    table = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in (given or rows)], FIELDS).repartition(6)
    got = [tuple(r) for r in whitening.whiten(table, **how).collect()]
    want = brute(rows, **how)
    got.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4])))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4])))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    sign = {}
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) <= 1e-9 * w[5]
        assert g[6] <= 1e-8
        if abs(w[4]) > 1e-6:
            assert sign.setdefault(g[1], g[4] * w[4] > 0) == (g[4] * w[4] > 0)
        assert abs(abs(g[4]) - abs(w[4])) < 1e-7
    return got


@pytest.fixture(scope="module")
def real(spark, folder):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]


def test_table_equals_numpy(spark, real):
    compare(spark, [r for r in real if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])], real)


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=5) * [9, 3, 1, .5, .1]]) for i in range(80)]
    good += [(3, good[3][1]), (None, good[4][1]), (None, [1.0, 2.0, 3.0, -4.0, 5.0]), (90, good[5][1])]
    bad = [(91, None), (92, []), (93, [1.0, 2.0]), (94, [1.0, None, 2.0, 3.0, 4.0]), (95, [1.0, float("nan"), 2.0, 3.0, 4.0]),
           (96, [1.0, float("inf"), 2.0, 3.0, 4.0]), (97, [1.0, 3e38, 2.0, 3.0, 4.0])]
    compare(spark, good, good + bad)
    compare(spark, good, good + bad, components=2)


def test_fewer_rows_than_dimensions(spark):
    rows = [(i, [float(i == k) * (1 + i) for k in range(12)]) for i in range(5)]
    assert {r[1] for r in compare(spark, rows)} == {1, 2, 3, 4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    table = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], FIELDS)
    assert whitening.whiten(table).collect() == []


def test_exact_beyond_longs():
    rows = np.array([[5, 1 << 40], [7, -(1 << 40)]], dtype=np.int64)
    assert whitening._deviation(rows, 2, [12, 0]) == [None, None]
    assert whitening._deviation(rows, 1, [5, (1 << 40) - 3]) == [9, None]
    assert whitening._deviation(rows[:, :1], 2, [12]) == [4, 4]
