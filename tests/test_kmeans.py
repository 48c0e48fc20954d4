"""k-means starts and steps against NumPy."""

import hashlib
import math

import numpy as np
import pytest

from tidemill.operators import kmeans as K


def _u(key, seed):
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:8], 16) / 2 ** 32


def _starts(x, k, seed):
    ids = [min(range(len(x)), key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))]
    for step in range(1, k):
        d = ((x[:, None] - x[ids][None]) ** 2).sum(axis=2).min(axis=1)
        ids.append(max((i for i in range(len(x)) if d[i] > 0), key=lambda i: (math.log(max(_u(i, seed + 1000 * step), 2 ** -33)) / d[i], -i)))
    return ids


def _lloyd(x, c):
    steps = 0
    while True:
        near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        if np.abs(new - c).max() <= 1e-9:
            return c, ((x - c[near]) ** 2).sum(), steps
        c, steps = new, steps + 1


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(m, 0.7, size=(60, 3)) for m in ((0, 0, 0), (3, 0, 0), (0, 3, 1))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(999, None, 1.0, 1.0), (998, 0.0, float("nan"), 1.0)], "id long, a double, b double, c double")
    return x, df.repartition(4)


def test_starts_and_fit_match_numpy(points):
    x, df = points
    fits = K.fit_many(df, "id", ["a", "b", "c"], [2, 4], n_init=3)
    for k, fit in fits.items():
        keys = [_starts(x, k, 42 + i) for i in range(3)]
        assert fit.start_keys == keys
        want = [_lloyd(x, x[q]) for q in keys]
        assert fit.steps == [w[2] for w in want]
        assert np.allclose(fit.inertias, [w[1] for w in want])
        best = min(range(3), key=lambda i: want[i][1])
        assert np.allclose(fit.centroids, want[best][0])
    got = {r["id"]: r["cluster"] for r in K.predict(df, ["a", "b", "c"], fits[4].centroids).collect()}
    assert got[999] is None and got[998] is None
    assert [got[i] for i in range(len(x))] == ((x[:, None] - fits[4].centroids[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()


def test_far_rows_are_drawn_more_often(points):
    x, df = points
    fit = K.fit(df, "id", ["a", "b", "c"], 3, n_init=10)
    assert sum(len({q // 60 for q in keys}) == 3 for keys in fit.start_keys) >= 5  # one start row in each cloud
    assert fit.inertia == min(fit.inertias)


def test_few_different_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(9)], "id long, a double")
    fit = K.fit(df, "id", ["a"], 4, n_init=2)
    assert sorted(fit.centroids.ravel()) == [0.0, 1.0] and fit.inertia == 0.0
    assert K.fit(df.limit(0), "id", ["a"], 2, n_init=2).centroids.size == 0
    assert len(K.fit(df, "id", ["a"], 3, n_init=1, start="random").start_keys[0]) == 3


def test_one_pass_keeps_digits_far_from_zero(spark):
    rng = np.random.default_rng(2)
    x = 1e6 + np.concatenate([rng.normal(m, 0.01, size=(5000, 2)) for m in ((0, 0), (0.2, 0), (0, 0.2))])
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "k long, x array<double>").repartition(3)
    starts = [x[[0, 5000, 10000]], x[[1, 2]]]
    new, cost = K.lloyd_pass(rows, starts)
    for c, n, v in zip(starts, new, cost):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert np.allclose(n, [x[d.argmin(axis=1) == j].mean(axis=0) for j in range(len(c))], rtol=0, atol=1e-8)
        assert abs(v - d.min(axis=1).sum()) < 1e-6 * v


def test_the_first_of_equal_starts_counts(points):
    x, df = points
    fit = K.fit(df, "id", ["a", "b", "c"], 2, n_init=6)
    same = [i for i, v in enumerate(fit.inertias) if v <= min(fit.inertias) * (1 + 1e-9)]
    assert np.allclose(fit.centroids, _lloyd(x, x[fit.start_keys[same[0]]])[0])
