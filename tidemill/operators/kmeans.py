"""k-means with D-squared starts and Lloyd steps to a fixpoint (K1, K9).

Several starts advance together: every pass reads the rows once, and each task returns, per start, its best
candidate for the next centre or its sums per cluster. Only rows that become centres and sums of
the size of the model reach the driver. A start's first centre is the row of the smallest seeded hash; each
further one is drawn with odds in proportion to the squared distance from the nearest centre so far, as the
row of the largest ``ln(u) / d`` with ``u`` the seeded hash of its key: the same rows in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_hex, hash_uniform
from tidemill.operators.cluster import sq_distances
from tidemill.operators.knn import squared_distances
from tidemill.session import discard, store

STARTS = ("k-means++", "random")
#: Rows whose distances to all centres a task holds at a time.
SLICE_ROWS = 4096
#: Share by which sums of squares of the same clusters may differ, added up in another order; of such starts the first counts.
TIE = 1e-10


@dataclass
class Fit:
    """Centroids of the best start, its within-cluster sum of squares, and per start the steps taken and its sum."""

    centroids: np.ndarray
    inertia: float
    steps: list[int]
    inertias: list[float]
    start_keys: list[list[int]]


def _rows(df: DataFrame, key: str, cols) -> DataFrame:
    """``k, x``: rows without a missing value."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    return df.select(F.col(key).cast("long").alias("k"), x.alias("x")).where("forall(x, v -> v IS NOT NULL AND NOT isnan(v))")


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def plus_plus(rows: DataFrame, k: int, seeds: list[int]) -> tuple[list[np.ndarray], list[list[int]]]:
    """Start centres per seed, and their keys. One pass per centre for all seeds; with fewer different rows than ``k``,
    a start has fewer centres."""
    first = rows.select(*[F.min_by(F.struct("k", "x"), F.struct(hash_hex("k", s), F.col("k"))).alias(f"s{i}") for i, s in enumerate(seeds)]).first()
    if first is None or first[0] is None:
        return [np.zeros((0, 0)) for _ in seeds], [[] for _ in seeds]
    centres = [np.array([r["x"]], float) for r in first]
    keys = [[r["k"]] for r in first]
    for step in range(1, k):
        drawn = rows.withColumn("u", F.array(*[hash_uniform("k", s + 1000 * step) for s in seeds]))

        def best(batches: Iterator[pa.RecordBatch], centres=centres) -> Iterator[pa.RecordBatch]:
            top: dict = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, u, ids = _matrix(batch, "x"), _matrix(batch, "u"), batch.column("k").to_numpy()
                for i, c in enumerate(centres):
                    d = squared_distances(x, c).min(axis=1)
                    with np.errstate(divide="ignore"):
                        odds = np.where(d > 0, np.log(np.maximum(u[:, i], 2.0 ** -33)) / np.where(d > 0, d, 1.0), -np.inf)
                    at = np.lexsort((ids, -odds))[0]
                    if np.isfinite(odds[at]) and (i not in top or (odds[at], -ids[at]) > (top[i][0], -top[i][1])):
                        top[i] = (odds[at], ids[at], x[at])
            if top:
                yield pa.RecordBatch.from_pydict({"start": pa.array(list(top), pa.int32()), "odds": [float(t[0]) for t in top.values()], "k": [int(t[1]) for t in top.values()],
                                                  "x": [t[2].tolist() for t in top.values()]})

        found = drawn.mapInArrow(best, "start int, odds double, k long, x array<double>")
        for r in found.groupBy("start").agg(F.max_by(F.struct("k", "x"), F.struct("odds", -F.col("k"))).alias("b")).collect():
            centres[r["start"]] = np.vstack([centres[r["start"]], r["b"]["x"]])
            keys[r["start"]].append(r["b"]["k"])
    return centres, keys


def random_rows(rows: DataFrame, k: int, seeds: list[int]) -> tuple[list[np.ndarray], list[list[int]]]:
    """The first ``k`` rows in the order of their seeded hash, per seed."""
    centres, keys = [], []
    for s in seeds:
        got = rows.orderBy(hash_hex("k", s), "k").limit(k).collect()
        centres.append(np.array([r["x"] for r in got], float))
        keys.append([r["k"] for r in got])
    return centres, keys


def lloyd_pass(rows: DataFrame, starts: list[np.ndarray]) -> tuple[list[np.ndarray], list[float]]:
    """New centroids and the sum of squares at the old ones, per start; a cluster without rows keeps its centroid. The centres of
    all starts meet a slice of rows in one product, taken around the middle of the centres, so that data far from zero lose
    no digits; a second product adds up the rows of every cluster."""
    cut = np.concatenate([[0], np.cumsum([len(c) for c in starts])])
    old = np.vstack(starts)
    middle = old.mean(axis=0)
    near = old - middle
    squares, turned = (near ** 2).sum(axis=1), -2.0 * near.T

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cost = np.zeros((cut[-1], near.shape[1] + 1)), np.zeros(len(starts))
        for batch in batches:
            every = _matrix(batch, "x") if batch.num_rows else np.empty((0, near.shape[1]))
            for at in range(0, len(every), SLICE_ROWS):
                x = every[at:at + SLICE_ROWS] - middle
                d = x @ turned + squares
                own = np.zeros(d.shape)
                n, length = np.arange(len(x)), (x ** 2).sum(axis=1)
                for i, (lo, hi) in enumerate(zip(cut, cut[1:])):
                    first = d[:, lo:hi].argmin(axis=1) + lo
                    own[n, first] = 1.0
                    cost[i] += np.maximum(d[n, first] + length, 0.0).sum()
                total[:, :-1] += own.T @ x
                total[:, -1] += own.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"at": np.arange(total.size + cost.size), "v": np.concatenate([total.ravel(), cost])})

    parts = rows.select("x").mapInArrow(sums, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()  # starts x clusters x features
    flat = np.zeros(cut[-1] * (near.shape[1] + 1) + len(starts))
    flat[parts.column("at").to_numpy()] = parts.column("v").to_numpy()
    total = flat[:-len(starts)].reshape(cut[-1], -1)
    new = np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1) + middle, old)
    return [new[lo:hi] for lo, hi in zip(cut, cut[1:])], [float(v) for v in flat[-len(starts):]]


def fit_many(df: DataFrame, key: str, cols, ks: list[int], n_init: int = 10, max_iter: int = 300, seed: int = 42, start: str = "k-means++",
             tol: float = 1e-9) -> dict[int, Fit]:
    """Per number of clusters the best of ``n_init`` starts by the sum of squares. All starts of all numbers advance in the same
    passes (a start's centres for fewer clusters are the first of those for more). A start has settled when no
    centroid moves by more than ``tol``; passes go on until all have. The rows are stored once as one array each and read
    once per pass."""
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}")
    rows, path = store(_rows(df, key, cols), "kmeans-rows")
    seeds = [seed + i for i in range(n_init)]
    first, keys = (plus_plus if start == "k-means++" else random_rows)(rows, max(ks), seeds)
    centres = {(k, i): c[:k] for k in ks for i, c in enumerate(first)}
    steps, inertia = dict.fromkeys(centres, 0), dict.fromkeys(centres, 0.0)
    open_ = [at for at, c in centres.items() if len(c)]
    while open_:
        new, cost = lloyd_pass(rows, [centres[at] for at in open_])
        still = []
        for at, c, v in zip(open_, new, cost):
            inertia[at] = v
            if np.abs(c - centres[at]).max() > tol and steps[at] < max_iter:
                steps[at] += 1
                centres[at] = c
                still.append(at)
        open_ = still
    discard(rows.sparkSession, path)
    out = {}
    for k in ks:
        full = [i for i in range(n_init) if len(centres[k, i])] or list(range(n_init))
        least = min(inertia[k, i] for i in full)
        best = next(i for i in full if inertia[k, i] <= least * (1 + TIE))  # starts that end in the same clusters differ by rounding
        out[k] = Fit(centres[k, best], least, [steps[k, i] for i in range(n_init)], [inertia[k, i] for i in range(n_init)], [q[:k] for q in keys])
    return out


def fit(df: DataFrame, key: str, cols, k: int, **kw) -> Fit:
    return fit_many(df, key, cols, [k], **kw)[k]


def predict(df: DataFrame, cols, centroids, out: str = "cluster") -> DataFrame:
    """Number of the nearest centroid (ties: the smaller); null where a value is missing."""
    d: Column = sq_distances(cols, centroids)
    return df.withColumn("_d", d).withColumn(out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_d")
