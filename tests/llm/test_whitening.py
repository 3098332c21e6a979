"""Whitening against whole-number sums in Python and numpy's eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caelum.llm import whitening


def brute(rows, most=8):
    """{vec_id: [(component, whitened)]}, n, deviations, explained: plain sums, numpy's eigh."""
    fit = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(fit), len(fit[0][1])
    sums = [sum(x[k] for _, x in fit) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for _, x in fit]
    z = np.array(centred, object)
    cov = ((z.T @ z) / n**3).astype(float)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    w = np.array(z / n, float) @ u / np.sqrt(e)
    return n, [(i, sum(x * x for x in c), w[k]) for k, ((i, _), c) in enumerate(zip(fit, centred))], e / cov.trace()


def check(got, rows):
    n, want, explained = brute(rows)
    k = len(explained)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    assert len(got) == len(want) * k and all(r["n"] == n for r in got)
    sign = None
    for i, deviation, w in want:
        own = by[i, deviation]
        assert sorted(own) == list(range(1, k + 1))
        v = np.array([own[c][0]["whitened"] for c in range(1, k + 1)])
        if sign is None and np.abs(w).min() > 1e-3:
            sign = np.sign(v * w)
    for i, deviation, w in want:
        for c in range(1, k + 1):
            # the same sign for all rows; rows equal in id and deviation may be different vectors
            assert any(abs(r["whitened"] * sign[c - 1] - w[c - 1]) < 1e-7 for r in by[i, deviation][c])
            assert all(abs(r["explained"] / explained[c - 1] - 1) < 1e-9 for r in by[i, deviation][c])
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(whitening.op13_whitening(spark, sf_dir).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(10) * np.arange(1, 11) + 7]) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (3, [0.5] * 10)]
    odd = [(100, None), (101, []), (102, [None] + [0.0] * 9), (103, [float("nan")] * 10), (104, [float("inf")] + [0.0] * 9)]
    frame = spark.createDataFrame([(i, v, "z", 1) for i, v in rows + odd], "vec_id long, embedding array<double>, dim string, whitened int")
    check(whitening.whiten(frame).collect(), rows)
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id >= 100")).count() == 0


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(2)
    a = [(i, [float(x) for x in rng.standard_normal(9) * np.arange(1, 10)]) for i in range(40)]
    b = [(i, [float(x) for x in rng.standard_normal(3) * np.arange(1, 4)]) for i in range(100, 130)]
    got = whitening.whiten(spark.createDataFrame(a + b, "vec_id long, embedding array<double>"))
    check(got.where("vec_id < 100").collect(), a)
    check(got.where("vec_id >= 100").collect(), b)


def test_no_spread(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(same).collect()
    assert len(got) == 10 and {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, 0.0, None)}
    line = whitening.whiten(same.withColumn("embedding", F.array(F.col("vec_id") * 1.0, F.col("vec_id") * 2.0))).collect()
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True}
    assert [round(r["explained"], 12) for r in line if r["vec_id"] == 0] == [1.0, 0.0] and line[0]["identity_error"] < 1e-12


def test_large_entries_stay_exact(spark):
    values = [(i, [i * 3.0e12 + k * 5.0e11 * (i % 3) for k in range(3)]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(values, "vec_id long, embedding array<double>")).where("component = 1").collect()
    assert all(r["deviation"] is None for r in got if r["vec_id"] in (0, 5)) and got[0]["n"] == 6
    big = np.array([[1 << 40, -(1 << 41)], [3, 1 << 40]])
    assert (whitening.gram(big) == big.astype(object).T @ big.astype(object)).all()
    assert sum(p << (40 * k) for k, p in whitening.limbs(-(10**30))) == -(10**30)


@pytest.mark.parametrize("kind", ["distinct", "indefinite", "multiple", "steep", "zero"])
@pytest.mark.parametrize("d", [1, 2, 7, 64])
def test_slicing(kind, d):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    spectrum = {
        "distinct": rng.random(d) * 9 + 1,
        "indefinite": rng.standard_normal(d),
        "multiple": np.repeat([5.0, 3.0, 1.0], [d // 3, d // 3, d - 2 * (d // 3)]),
        "steep": 10.0 ** -np.arange(d).clip(0, 12),
        "zero": np.zeros(d),
    }[kind]
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    want = np.sort(spectrum)[::-1]
    for shift in (want[0] + 1, (want[0] + want[-1]) / 2 + 0.01, want[-1] - 1):
        assert whitening.above(a, shift) == (want > shift).sum()
    values, vectors = whitening.leading(a, 8)
    k = min(d, 8)
    assert np.abs(values - want[:k]).max() < 1e-13 * max(1, want[0])
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * 5 and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
