"""Gaussian naive Bayes (M10): class moments in one aggregate, scores as a matrix step.

Fit: each task sums counts, values and squares of the centred values per class and feature, and a
``groupBy(class, feature)`` adds them up; the variance floor is ``1e-9 * max_j var(X_j)`` as in the
reference's estimator. The parameters are classes x features (model-sized); a row's log-likelihoods are
computed an Arrow batch at a time, so prediction needs no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_moments(df: DataFrame, cols: list[str], label: str, centre: list[float]) -> DataFrame:
    """``label, j, n, s, q``: per class and feature the count, sum and sum of squares of ``value - centre``; a task sends one row
    per class and feature. Missing values are left out."""
    c = np.array(centre, float)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for frame in frames:
            for y, part in frame.groupby("y", sort=False):
                x = np.vstack([np.asarray(v, float) for v in part["x"]]) - c
                there = ~np.isnan(x)
                x = np.where(there, x, 0.0)
                now = sums.setdefault(y, np.zeros((3, len(c))))
                now += np.stack([there.sum(axis=0), x.sum(axis=0), (x * x).sum(axis=0)])
        for y, (n, s, q) in sums.items():
            yield pd.DataFrame({"y": y, "j": range(len(c)), "n": n.astype(np.int64), "s": s, "q": q})

    vector = F.array(*[F.col(k).cast("double") for k in cols])
    kind = df.schema[label].dataType.simpleString()
    parts = df.where(F.col(label).isNotNull()).select(F.col(label).alias("y"), vector.alias("x")).mapInPandas(run, f"y {kind}, j int, n bigint, s double, q double")
    return parts.groupBy("y", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))


def fit_gaussian_nb(train: DataFrame, cols, label: str, var_smoothing: float = 1e-9) -> dict:
    cols = list(cols)
    centre = train.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centre = [float(centre[c] or 0.0) for c in cols]
    rows = class_moments(train, cols, label, centre).collect()  # classes x features
    sizes = {r[label]: r["n"] for r in train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(sizes)
    n, s, q = (np.zeros((len(classes), len(cols))) for _ in range(3))
    at = {c: i for i, c in enumerate(classes)}
    for r in rows:
        n[at[r["y"]], r["j"]], s[at[r["y"]], r["j"]], q[at[r["y"]], r["j"]] = r["n"], r["s"], r["q"]

    def spread(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.maximum(q / np.maximum(n, 1) - (s / np.maximum(n, 1)) ** 2, 0.0)

    eps = var_smoothing * float(spread(n.sum(axis=0), s.sum(axis=0), q.sum(axis=0)).max(initial=0.0))
    total = sum(sizes.values())
    return {
        "cols": cols,
        "classes": classes,
        "log_prior": [math.log(sizes[c] / total) for c in classes],
        "mean": (np.array(centre) + s / np.maximum(n, 1)).tolist(),
        "var": (spread(n, s, q) + eps).tolist(),
    }


def predict_gaussian_nb(df: DataFrame, model: dict, out: str = "prediction") -> DataFrame:
    """Class of the largest log-likelihood (ties: the smaller class); null where a value is missing."""
    prior, mean, var = (np.array(model[k], float) for k in ("log_prior", "mean", "var"))
    fixed = prior - 0.5 * np.log(2 * math.pi * var).sum(axis=1)

    @F.pandas_udf("int")
    def best(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="Int32")
        x = np.array([np.asarray(v, float) for v in rows]).reshape(len(rows), -1)
        score = np.stack([f - ((x - m) ** 2 / (2 * v)).sum(axis=1) for f, m, v in zip(fixed, mean, var)], axis=1)
        return pd.Series(np.where(np.isnan(x).any(axis=1), None, score.argmax(axis=1) + 1))

    classes = F.array(*[F.lit(c) for c in model["classes"]])
    return df.withColumn(out, F.element_at(classes, best(F.array(*[F.col(c).cast("double") for c in model["cols"]]))))
