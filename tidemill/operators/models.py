"""Model fitting and scoring on MLlib.

Parameter mappings make MLlib minimise the same objective as the reference's
estimators where that is possible (least squares, ridge, lasso, logistic, Gaussian
naive Bayes). Where MLlib has no counterpart (kernel SVM/SVR, extremely randomised
trees) a documented approximation is built from MLlib parts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def assembler(feature_cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="error")


def least_squares(features: str = "features", label: str = "label") -> LinearRegression:
    """M1: ordinary least squares (normal equations, d x d on the driver)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="normal",
                            standardization=False)


def ridge(alpha: float, y_std_pop: float, n: int, features: str = "features",
          label: str = "label") -> LinearRegression:
    """M2: ridge with sklearn's ``alpha`` (objective ||y-Xb||^2 + alpha ||b||^2).
    MLlib scales its penalty by the label deviation and 1/n."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=alpha * y_std_pop / n,
                            elasticNetParam=0.0, standardization=False, solver="normal")


def lasso(alpha: float, features: str = "features", label: str = "label",
          max_iter: int = 1000) -> LinearRegression:
    """M3: lasso with sklearn's ``alpha`` (objective 1/(2n)||y-Xb||^2 + alpha ||b||_1)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
                            standardization=False, maxIter=max_iter, tol=1e-10)


def logistic(c: float, n: int, features: str = "features", label: str = "label",
             max_iter: int = 1000, weight_col: str | None = None) -> LogisticRegression:
    """M5: L2 logistic regression with sklearn's ``C`` (regParam = 1 / (C n))."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * n),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-10)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def decision_tree(max_depth: int = 30, max_bins: int = 256, seed: int = 42,
                  features: str = "features", label: str = "label") -> DecisionTreeClassifier:
    """M6: gini tree; depth capped at MLlib's limit of 30 (the reference is unlimited)."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, impurity="gini",
                                  maxDepth=min(max_depth, 30), maxBins=max_bins, seed=seed)


def random_forest(num_trees: int = 100, max_depth: int = 30, seed: int = 42, weight_col: str | None = None,
                  features: str = "features", label: str = "label",
                  bootstrap: bool = True) -> RandomForestClassifier:
    """M7: random forest classifier, ``sqrt`` features per split, optional class weights."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                maxDepth=min(max_depth, 30), featureSubsetStrategy="sqrt", seed=seed,
                                bootstrap=bootstrap, maxBins=256)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def random_forest_regressor(num_trees: int = 200, max_depth: int = 30, seed: int = 42,
                            features: str = "features", label: str = "label") -> RandomForestRegressor:
    """M8: forest regressor considering all features per split (sklearn's default)."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees,
                                 maxDepth=min(max_depth, 30), featureSubsetStrategy="all", seed=seed)


def gradient_boosting(max_iter: int = 100, step: float = 0.1, depth: int = 3, seed: int = 42,
                      features: str = "features", label: str = "label"):
    """M9: gradient-boosted trees (sklearn defaults), binary labels (MLlib's booster has no multi-class form)."""
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, stepSize=step,
                         maxDepth=depth, seed=seed)


def gaussian_nb(features: str = "features", label: str = "label") -> NaiveBayes:
    """M10 (MLlib form): Gaussian naive Bayes; the SQL-checkable form is in ``bayes``."""
    return NaiveBayes(featuresCol=features, labelCol=label, modelType="gaussian")


# ---- random Fourier features (M11, M12) -------------------------------------------------

class FourierMap:
    """Random Fourier features for the RBF kernel exp(-gamma ||x - y||^2)
    (Rahimi & Recht, 2007): z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi).

    W is D x d (model-sized, shipped once in the UDF closure); the map itself is an
    Arrow-batched pandas UDF over an ``array<double>`` column, one matrix product per batch.
    """

    def __init__(self, d: int, n_components: int = 512, gamma: float = 1.0, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d))
        self.b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
        self.scale = math.sqrt(2.0 / n_components)

    def column(self, arr: Column) -> Column:
        w, b, scale = self.w, self.b, self.scale

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def _map(s: pd.Series) -> pd.Series:
            if len(s) == 0:
                return pd.Series([], dtype=object)
            x = np.vstack(s.to_numpy())
            z = scale * np.cos(x @ w.T + b)
            return pd.Series(list(z))

        return _map(arr)

    def transform(self, df: DataFrame, features: str = "features", out: str = "rff") -> DataFrame:
        return df.withColumn(out, array_to_vector(self.column(vector_to_array(F.col(features)))))


def gamma_scale(df: DataFrame, feature_cols: list[str]) -> float:
    """sklearn's ``gamma='scale'`` = 1 / (d * var(X)) over all feature values."""
    long = df.select(F.explode(F.array(*[F.col(c).cast("double") for c in feature_cols])).alias("v"))
    var = long.agg(F.var_pop("v")).first()[0]
    return 1.0 / (len(feature_cols) * var) if var else 1.0


def rbf_svc(c: float, n: int, features: str = "rff", label: str = "label", n_classes: int = 2,
            max_iter: int = 100):
    """Kernel SVM approximated by a linear SVM on random Fourier features (apply a
    ``FourierMap`` first); multi-class one-vs-rest (the reference is one-vs-one)."""
    svc = LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (c * n), maxIter=max_iter)
    if n_classes > 2:
        return OneVsRest(classifier=svc, featuresCol=features, labelCol=label)
    return svc


def rbf_svr(features: str = "rff", label: str = "label", c: float = 100.0, n: int = 1):
    """Kernel SVR approximated by a Huber-loss linear model on Fourier features
    (epsilon-insensitive loss is not in MLlib)."""
    return LinearRegression(featuresCol=features, labelCol=label, loss="huber", regParam=1.0 / (c * n),
                            maxIter=200)


# ---- extremely randomised trees, approximated (M13) -------------------------------------

def random_cut_points(mins: list[float], maxs: list[float], cuts: int, seed: int) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    out = []
    for lo, hi in zip(mins, maxs):
        pts = np.sort(rng.uniform(lo, hi, size=cuts)) if hi > lo else np.array([])
        out.append([-math.inf] + [float(p) for p in pts] + [math.inf])
    return out


def extra_trees_proxy(train: DataFrame, feature_cols: list[str], label: str = "label", groups: int = 8,
                      trees_per_group: int = 100, cuts: int = 31, seed: int = 42, max_depth: int = 30):
    """Per group, random cut points inside each feature's [min, max] bucketize the
    features, then a forest without bootstrap is fitted on the buckets; predictions
    average the groups' probabilities. Returns a list of fitted PipelineModels."""
    from pyspark.ml.feature import Bucketizer

    stats = train.agg(*[F.min(c).alias(f"mn_{c}") for c in feature_cols],
                      *[F.max(c).alias(f"mx_{c}") for c in feature_cols]).first()
    mins = [float(stats[f"mn_{c}"]) for c in feature_cols]
    maxs = [float(stats[f"mx_{c}"]) for c in feature_cols]
    models = []
    for g in range(groups):
        splits = random_cut_points(mins, maxs, cuts, seed + g)
        bk = Bucketizer(splitsArray=splits, inputCols=feature_cols,
                        outputCols=[f"_b_{c}" for c in feature_cols], handleInvalid="keep")
        va = VectorAssembler(inputCols=[f"_b_{c}" for c in feature_cols], outputCol="_bf")
        rf = RandomForestClassifier(featuresCol="_bf", labelCol=label, numTrees=trees_per_group,
                                    bootstrap=False, featureSubsetStrategy="sqrt", seed=seed + g,
                                    maxDepth=min(max_depth, 30), probabilityCol=f"_p{g}",
                                    rawPredictionCol=f"_r{g}", predictionCol=f"_y{g}")
        models.append(Pipeline(stages=[bk, va, rf]).fit(train))
    return models


def extra_trees_predict(models: list[PipelineModel], df: DataFrame, keep: list[str]) -> DataFrame:
    out = df
    for g, m in enumerate(models):
        out = m.transform(out)
        out = out.drop("_bf", f"_r{g}", f"_y{g}", *[c for c in out.columns if c.startswith("_b_")])
        out = out.withColumn(f"_p{g}", vector_to_array(F.col(f"_p{g}")))
    n = len(models)
    prob = F.col("_p0")
    for g in range(1, n):
        prob = F.zip_with(prob, F.col(f"_p{g}"), lambda a, b: a + b)
    prob = F.transform(prob, lambda v: v / n)
    pred = (F.array_position(prob, F.array_max(prob)) - 1).cast("double")
    return out.select(*keep, prob.alias("probability"), pred.alias("prediction"))


# ---- model introspection (M14-M16) ------------------------------------------------------

def importance_table(model, feature_cols: list[str], top: int | None = 10) -> list[tuple[str, float]]:
    """Tree / forest feature importances, largest first (model-sized)."""
    return importance_rows(model.featureImportances.toArray(), feature_cols, top)


def importance_rows(importances, feature_cols: list[str], top: int | None = 10) -> list[tuple[str, float]]:
    rows = sorted(zip(feature_cols, [float(v) for v in importances]), key=lambda r: (-r[1], r[0]))
    return rows[:top] if top else rows


def coefficient_table(model, feature_cols: list[str]) -> list[tuple[str, float]]:
    """Coefficients sorted by absolute value, sign kept."""
    coefs = [float(v) for v in model.coefficients.toArray()]
    return sorted(zip(feature_cols, coefs), key=lambda r: (-abs(r[1]), r[0]))


def score_signal(pred_col_df: DataFrame, positive_index: int = 1) -> Column:
    """Positive-class probability when the model gives one, else the raw score."""
    if "probability" in pred_col_df.columns:
        return vector_to_array(F.col("probability"))[positive_index]
    return vector_to_array(F.col("rawPrediction"))[positive_index]
