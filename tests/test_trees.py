"""Trees grown in aggregates against plain recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import trees as T


def _score(y, left, k):
    out = 0.0
    for part in (y[left], y[~left]):
        n = np.bincount(part, minlength=k).astype(float)
        out += (n ** 2).sum() / n.sum()
    return out


def _exact(x, y, k, name=1):
    """``{node: (feature, threshold)}`` by trying every midpoint."""
    if len(set(y)) < 2:
        return {}
    best = None
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        for a, b in zip(v, v[1:]):
            t = (a + b) / 2 if (a + b) / 2 < b else a
            s = _score(y, x[:, j] <= t, k)
            if best is None or s > best[0]:
                best = (s, j, t)
    if best is None:
        return {}
    _, j, t = best
    left = x[:, j] <= t
    return {name: (j, t)} | _exact(x[left], y[left], k, 2 * name) | _exact(x[~left], y[~left], k, 2 * name + 1)


def _extra(x, y, k, tree, m, seed, name=1):
    if len(set(y)) < 2:
        return {}
    d = x.shape[1]
    for attempt in range((d + m - 1) // m):
        tried = []
        for j in T.drawn(tree, name, attempt, d, m, seed):
            lo, hi = x[:, j].min(), x[:, j].max()
            if lo < hi:
                t = lo + T.uniform(f"{tree}|{name}|{j}|cut|{seed}") * (hi - lo)
                tried.append((j, lo if t >= hi else t))
        if tried:
            j, t = max(tried, key=lambda c: _score(y, x[:, c[0]] <= c[1], k))
            left = x[:, j] <= t
            return {name: (j, t)} | _extra(x[left], y[left], k, tree, m, seed, 2 * name) | _extra(x[~left], y[~left], k, tree, m, seed, 2 * name + 1)
    return {}


def _splits(tree):
    return {tree.name[i]: (tree.feature[i], tree.threshold[i]) for i in range(len(tree.name)) if tree.feature[i] >= 0}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 6, 150), rng.normal(size=150), np.full(150, 2.0), rng.integers(0, 2, 150), np.full(150, -1.0)]).astype(float)
    y = (x[:, 0] + x[:, 1] > 3).astype(int) + (x[:, 3] * (x[:, 1] > 0.5)).astype(int)
    x[-6:], y[-6:] = x[0], [0, 1, 2, 0, 1, 2]  # alike rows of different classes stay together
    cols = ["a", "b", "c", "d", "e"]
    rows = [(*map(float, r), int(v)) for r, v in zip(x, y)] + [(None, 1.0, 2.0, 0.0, -1.0, 1), (1.0, float("nan"), 2.0, 0.0, -1.0, 1), (1.0, 1.0, 2.0, 0.0, -1.0, None)]
    return x, y, cols, spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y int").repartition(3)


@pytest.mark.parametrize("window_rows", [T.WINDOW_ROWS, 40])
def test_exact_tree_is_the_greedy_tree(table, window_rows):
    x, y, cols, df = table
    forest = T.fit_tree(df, cols, "y", window_rows=window_rows)
    assert _splits(forest.trees[0]) == _exact(x, y, 3)
    assert sum(forest.trees[0].counts[0]) == 150
    got = forest.predict(df.where("y IS NOT NULL AND a IS NOT NULL AND NOT isnan(b)")).agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    assert got >= 1 - 5 / 150


def test_depth_has_no_cap(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(66)], "a double, y int")
    forest = T.fit_tree(df, ["a"], "y")  # equal scores: every split cuts one row off
    assert forest.trees[0].depth() > 30
    assert forest.predict(df).where("prediction <> y").count() == 0


@pytest.mark.parametrize("pass_nodes", [T.PASS_NODES, 7])
def test_extra_trees_are_the_drawn_trees(table, pass_nodes):
    x, y, cols, df = table
    forest = T.fit_extra_trees(df, cols, "y", trees=4, pass_nodes=pass_nodes)
    for t, tree in enumerate(forest.trees):
        assert _splits(tree) == _extra(x, y, 3, t, 2, 42)
    one = forest.predict(df.limit(50)).select("probability").collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in one)


@pytest.mark.parametrize("local_rows", [0, 12, 60])
def test_deep_nodes_of_extra_trees_stay_in_tasks(table, local_rows):
    """Wherever a node is grown, the trees and the predictions are the same, and the driver holds no node below a small one."""
    x, y, cols, df = table
    forest = T.fit_extra_trees(df, cols, "y", trees=3, local_rows=local_rows)
    for t, tree in enumerate(forest.trees):
        assert _splits(tree) == _extra(x, y, 3, t, 2, 42)
    for tree in forest.tops:
        assert all(tree.counts[i].sum() > local_rows for i in range(len(tree.name)) if tree.feature[i] >= 0)
    assert sum(len(t.name) for t in forest.tops) < sum(len(t.name) for t in forest.trees) or local_rows == 0
    whole = T.Forest(forest.classes, forest.features, forest.trees, 0)
    rows = lambda f: sorted(str((r["a"], r["b"], r["d"], r["prediction"], r["probability"])) for r in f.predict(df).collect())
    assert rows(forest) == rows(whole)


def test_one_class_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5)], "a double, y int")
    for fit in (T.fit_tree, T.fit_extra_trees):
        assert {r["prediction"] for r in fit(df, ["a"], "y").predict(df).collect()} == {5.0}
        assert [r["prediction"] for r in fit(df.limit(0), ["a"], "y").predict(df).collect()] == [None, None]


def test_draws_are_the_same_in_tasks_and_on_the_driver(spark):
    from tidemill.operators import trees

    nodes = [(t, (1 << 70) + node, attempt) for t in range(3) for node in range(20) for attempt in range(3)]
    here, there = (trees._draw_all(spark.range(1), nodes, 8, 3, 42, local) for local in (1000, 10))
    for a, b in zip(here, there):
        assert a.tolist() == b.tolist()
    assert (here[0][2::3, 2] == -1).all() and (here[0][:, :2] >= 0).all()
    assert here[0][0].tolist() == trees.drawn(0, 1 << 70, 0, 8, 3, 42)
