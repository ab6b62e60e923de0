"""Contour integration against a dense eigensolver, and the whitening against numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.llm import queries, whitening


def rotated(eigenvalues, seed=0) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(eigenvalues),) * 2))
    a = q @ np.diag(eigenvalues) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "even": np.linspace(1, 64, 64),
    "steep": 2.0 ** -np.arange(40),
    "equal": np.array([5.0] * 20 + [3.0] * 20 + [1.0] * 5),
    "close": np.array([1 + 1e-9 * k for k in range(12)] + [0.5 + 1e-5 * k for k in range(30)]),
    "low rank": np.array([4.0, 2.0, 1.0] + [0.0] * 20),
    "one": np.array([7.0]),
    "huge": 1e12 * np.array([3.0, 2.0, 1.0, 0.5]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_components_of_known_spectra(name):
    a = rotated(SPECTRA[name])
    e, v = whitening.components(a, 32)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:32]
    want = want[want > 8 * len(a) * whitening.EPS * want[0]]
    assert np.allclose(e, want, rtol=0, atol=1e-13 * want[0]) and len(e) == len(want)
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-13
    assert np.abs(a @ v - v * e).max() < 1e-12 * want[0]


def test_inertia_counts_what_lies_below():
    for seed in range(5):
        a = rotated(np.random.default_rng(seed).standard_normal(17), seed)
        e = np.linalg.eigvalsh(a)
        assert [whitening.below(a, s) for s in np.linspace(-3, 3, 40)] == [(e < s).sum() for s in np.linspace(-3, 3, 40)]
    assert whitening.below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1 and whitening.below(np.zeros((3, 3)), 0.0) == 0


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        whitening.inside(np.diag([1.0, 2.0, 3.0, 9.0]), 0.5, 3.5, 4, rounds=12)


def brute(x: np.ndarray):
    n, sums = len(x), x.sum(0)
    y = x - sums / n
    e, v = np.linalg.eigh(y.T @ y / n)
    return y, e[::-1], v[:, ::-1], [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]


def test_query(spark, sf_dir):
    got = queries.op12_whitening(spark, sf_dir).orderBy("vec_id", "component").toPandas()
    rows = queries.table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in r["embedding"]] for r in rows], np.int64)
    y, e, v, deviation = brute(x)
    assert len(got) == 32 * len(x) and set(got["n"]) == {len(x)} and set(got["component"]) == set(range(1, 33))
    z = got["whitened"].to_numpy().reshape(len(x), 32)
    want = y @ v[:, :32] / np.sqrt(e[:32])
    sign = np.sign((z * want).sum(0))
    assert np.abs(z * sign - want).max() < 1e-8
    assert np.abs(z.T @ z / len(x) - z.mean(0)[:, None] * z.mean(0) - np.eye(32)).max() < 1e-9
    assert got["deviation"].to_numpy().reshape(len(x), 32)[:, 0].tolist() == deviation
    assert np.allclose(got["explained"].to_numpy().reshape(len(x), 32)[0], e[:32] / e.sum(), rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"][0] < 1e-9


SCHEMA = "vec_id long, embedding array<float>, n long, component int"


def on(spark, rows, monkeypatch):
    d = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *_: d)
    return sorted(map(tuple, queries.op12_whitening(spark, "").collect()), key=str)


def test_nulls_repeats_and_degenerate_tables(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25, 1.0]), (1, [0.5, 0.25, 1.0]), (None, [-0.5, 0.75, 1.0]), (3, [0.0, 0.0, 1.0])]
    bad = [(4, None), (5, [1.0, None, 0.0]), (6, [nan, 0.0, 0.0]), (7, [0.0, inf, 0.0]), (8, [])]
    got = on(spark, [(*r, 9, 9) for r in good + bad], monkeypatch)
    assert sorted({(r[0] is None, r[0]) for r in got}, key=str) == sorted([(False, 1), (False, 3), (True, None)], key=str)
    assert len(got) == 4 * 2 and {r[2] for r in got} == {4}  # the third dimension is constant
    assert all(r[6] < 1e-9 for r in got)
    assert on(spark, [], monkeypatch) == on(spark, [(1, None, 1, 1)], monkeypatch) == []
    assert on(spark, [(k, [1.0, 2.0], 1, 1) for k in range(3)], monkeypatch) == []  # nothing varies
    with pytest.raises(Exception, match="different lengths"):
        on(spark, [(1, [1.0], 1, 1), (2, [1.0, 2.0], 1, 1)], monkeypatch)


def test_large_sums_stay_exact(spark):
    big = [[10**12 + k, -(10**12) * k] for k in range(5)]
    d = spark.createDataFrame([(k, x) for k, x in enumerate(big)], "vec_id long, x array<long>")
    model = whitening.fit(d)
    assert model.sums == (5 * 10**12 + 10, -10 * 10**12)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(d, model).collect()}
    assert got == {k: sum((5 * v - s) ** 2 for v, s in zip(x, model.sums)) for k, x in enumerate(big)}
    assert whitening.whiten(d, model).filter(F.size("whitened") != len(model.eigenvalues)).isEmpty()
