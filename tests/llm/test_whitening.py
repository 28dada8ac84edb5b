"""Whitening against numpy's own solver and exact integers."""

import math

import numpy as np
import pytest

from pageloom.llm import whitening as w
from pageloom.llm.whitening import deviations, eigen, op13_whitening, polar, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, whitened int"


def turned(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [3.0], [2.0, 1.0], [1.0] * 6, [0.0] * 4, [5, 5, 5, 1, 1, 0], list(np.logspace(0, -10, 24)), [1.0] * 20 + [1 + 1e-9] * 20, list(np.linspace(1, 2, 64)),
        [1e6] + [1.0] * 30, [0.0] * 10 + [1.0], [1.0, 1 - 1e-13, 0.5, 0.5 + 1e-12, 1e-8],
    ],
)
@pytest.mark.parametrize("wanted", [3, 100])
def test_eigen(values, wanted):
    a = turned(values)
    a = (a + a.T) / 2
    got, vectors = eigen(a, wanted)
    true = np.linalg.eigvalsh(a)[::-1][:wanted]
    norm = max(np.abs(values).max(), 1e-300)
    assert len(got) == min(wanted, len(values)) and np.all(np.diff(got) <= 0)
    assert np.abs(got - true).max() <= 1e-13 * norm * len(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-13 * norm * len(values)


def test_equal_diagonal():
    a = np.full((9, 9), 0.3) + 0.7 * np.eye(9)
    values, _ = eigen(a, 9)
    assert np.allclose(values, [3.4, *[0.7] * 8], atol=1e-14)


def test_polar_factor():
    a = turned([4.0, 1e-9, -1e-12, -3.0], 2)
    u = polar(a)
    assert np.abs(u @ u - np.eye(4)).max() < 1e-13
    assert np.allclose(u, turned([1.0, 1.0, -1.0, -1.0], 2), atol=1e-3)


def brute(rows, components):
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) and abs(64 * c) < 2**50 for c in r[1])]
    sizes = [len(r[1]) for r in good]
    good = [r for r in good if len(r[1]) == min(sizes, key=lambda s: (-sizes.count(s), s))]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((n * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[(n * v - s) / n for v, s in zip(r, sums, strict=True)] for r in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return {r[0]: (e, z) for r, e, z in zip(good, exact, centred @ vectors / np.sqrt(np.maximum(values, 1e-300)), strict=True)}, n, sums, values / (np.trace(covariance) or 1)


def check(spark, rows, partitions=3, components=32):
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], SCHEMA).repartition(partitions)
    out, fit, error = whiten(df, components=components)
    got = out.collect()
    want, n, sums, shares = brute(rows, components)
    assert (fit.n, fit.sums, len(got)) == (n, sums, len(want))
    assert np.allclose(fit.explained, shares, rtol=1e-9, atol=1e-15) and error < 1e-9
    for r in got:
        exact, z = want[r["vec_id"]]
        assert r["deviation"] == exact
        assert len(r["whitened"]) == len(z)
        for a, b, usable in zip(r["whitened"], z, fit.usable, strict=True):
            assert (abs(abs(a) - abs(b)) < 1e-7) if usable else a is None
    return got, fit


def cloud(n, width, seed=0, shift=0.0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(width, width)) * np.linspace(1, 4, width)
    return [(i, (rng.normal(size=width) @ base + shift).tolist(), 0) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(w, "MERGED_AT_ONCE", 2)
    monkeypatch.setattr(w, "ROWS_AT_ONCE", 7)
    check(spark, cloud(300, 8), partitions=9)
    check(spark, cloud(200, 40, 1, 1000.0), components=5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 0), (2, [], 0), (3, [1.0, None, 2.0], 0), (4, [nan, 0.0, 1.0], 0), (5, [inf, 0.0, 1.0], 0), (6, [-inf, 0.0, 1.0], 0), (7, [3e38, 0.0, 0.0], 0), (8, [1.0, 2.0], 0)]
    good = [(100 + i, v[1], None) for i, v in enumerate(cloud(50, 3, 2))] + [(300, [0.0, 0.0, 0.0], 1)]
    got, _ = check(spark, bad + good)
    assert {r["vec_id"] for r in got} == {r[0] for r in good}
    # A dimension that never varies, one vector alone, equal vectors, a null id.
    _, fit = check(spark, [(i, [float(i % 5), 7.0, float(i * i % 7)], 0) for i in range(40)])
    assert fit.usable.tolist() == [True, True, False]
    _, fit = check(spark, [(None, [1.0, 2.0], 0)])
    assert not fit.usable.any() and fit.explained == [0.0, 0.0]
    check(spark, [(i, [0.5, 0.25], 0) for i in range(4)])


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None, 1, "x", 2)], SCHEMA)
    for rows in (df, df.limit(0)):
        out, fit, error = whiten(rows)
        assert out.columns == ["vec_id", "deviation", "whitened"] and out.count() == 0 and (fit, error) == (None, 0.0)


def test_large_numbers_stay_exact():
    x = np.array([[2**49, -(2**49), 3], [5, 6, 7]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert deviations(x, 2, sums) == [sum((2 * int(v) - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = op13_whitening(spark, sf).toPandas()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, n, _, shares = brute(rows, 32)
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == len(want) * len(shares) and (got["n"] == n).all() and (got["identity_error"] < 1e-9).all()
    got = got.sort_values(["vec_id", "component"])
    table = np.abs(got["whitened"].to_numpy().reshape(len(want), -1))
    assert np.allclose(table, np.abs([want[i][1] for i in sorted(want)]), atol=1e-6)
    assert got["deviation"].to_numpy().reshape(len(want), -1)[:, 0].tolist() == [want[i][0] for i in sorted(want)]
    assert np.allclose(got["explained"].to_numpy()[: len(shares)], shares, rtol=1e-9)
