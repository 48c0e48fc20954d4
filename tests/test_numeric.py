"""Closed-form checks (NumPy) for the fitted estimators and transformers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tidemill.operators import models as M
from tidemill.operators.bayes import fit_gaussian_nb
from tidemill.operators.decompose import components_for_share, fit_pca
from tidemill.operators.encode import apply_standardizer, fit_standardizer
from tidemill.plans.common import emb

E8 = [f"e{i}" for i in range(1, 9)]


@pytest.fixture(scope="module")
def data(spark):
    d = emb(spark, SF_MID, 8).withColumn("target", 3 * F.col("e1") - 2 * F.col("e2") + F.col("e3") * F.col("e3"))
    pdf = d.toPandas()
    return d, pdf


def _xy(d, label):
    return M.assembler(E8).transform(d).withColumn("label", F.col(label).cast("double"))


def test_least_squares_equals_normal_equations(data):
    d, pdf = data
    model = M.least_squares().fit(_xy(d, "target"))
    X = np.c_[np.ones(len(pdf)), pdf[E8].to_numpy()]
    beta = np.linalg.lstsq(X, pdf["target"].to_numpy(), rcond=None)[0]
    assert abs(model.intercept - beta[0]) < 1e-8
    assert np.allclose(model.coefficients.toArray(), beta[1:], atol=1e-8)


def test_ridge_equals_closed_form(data):
    d, pdf = data
    y = pdf["target"].to_numpy()
    X = pdf[E8].to_numpy()
    model = M.ridge(1.0, float(np.std(y)), len(y)).fit(_xy(d, "target"))
    Xc, yc = X - X.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(X.shape[1]), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), beta, atol=1e-5)


def test_lasso_equals_coordinate_descent(data):
    d, pdf = data
    y = pdf["target"].to_numpy()
    X = pdf[E8].to_numpy()
    alpha = 0.001
    model = M.lasso(alpha).fit(_xy(d, "target"))
    Xc, yc = X - X.mean(0), y - y.mean()
    n = len(y)
    b = np.zeros(X.shape[1])
    for _ in range(5000):
        for j in range(X.shape[1]):
            r = yc - Xc @ b + Xc[:, j] * b[j]
            rho = Xc[:, j] @ r / n
            z = Xc[:, j] @ Xc[:, j] / n
            b[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / z
    assert np.allclose(model.coefficients.toArray(), b, atol=1e-4)


def test_logistic_gradient_of_sklearn_objective_vanishes(data):
    d, pdf = data
    train = _xy(d, "ring")
    n = len(pdf)
    model = M.logistic(1.0, n).fit(train)
    X = pdf[E8].to_numpy()
    y = pdf["ring"].to_numpy()
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(X @ w + b)))
    grad_w = w + 1.0 * X.T @ (p - y)   # sklearn: 0.5||w||^2 + C * sum logloss
    grad_b = np.sum(p - y)
    assert np.max(np.abs(grad_w)) < 1e-3 * n and abs(grad_b) < 1e-3 * n


def test_pca_matches_numpy(data):
    d, pdf = data
    fit = fit_pca(d, E8)
    X = pdf[E8].to_numpy()
    Xc = X - X.mean(0)
    vals, vecs = np.linalg.eigh(np.cov(Xc.T))
    order = np.argsort(vals)[::-1]
    ratio = vals[order] / vals.sum()
    assert np.allclose(fit.explained, ratio, atol=1e-9)
    for i in range(2):
        v = vecs[:, order[i]]
        v = v if v[np.argmax(np.abs(v))] > 0 else -v
        assert np.allclose(fit.components[i], v, atol=1e-6)
    k = components_for_share(fit, 0.9)
    assert np.cumsum(ratio)[k - 1] >= 0.9 - 1e-12 and (k == 1 or np.cumsum(ratio)[k - 2] < 0.9)
    proj = fit.transform(d, 2).select("pca").toPandas()["pca"].tolist()
    assert np.allclose(np.array(proj), Xc @ fit.components[:2].T, atol=1e-9)


def test_standardizer_population_deviation(data):
    d, pdf = data
    st = fit_standardizer(d, ["e1"])
    z = apply_standardizer(d.select("vec_id", "e1").orderBy("vec_id"), st).toPandas()["e1"].to_numpy()
    x = pdf.sort_values("vec_id")["e1"].to_numpy()
    assert np.allclose(z, (x - x.mean()) / x.std(), atol=1e-12)


def test_gaussian_nb_parameters(data):
    d, pdf = data
    m = fit_gaussian_nb(d, E8, "y3")
    eps = 1e-9 * pdf[E8].var(ddof=0).max()
    for ci, c in enumerate(m["classes"]):
        sub = pdf[pdf["y3"] == c][E8]
        assert np.allclose(m["mean"][ci], sub.mean().to_numpy())
        assert np.allclose(m["var"][ci], sub.var(ddof=0).to_numpy() + eps)
        assert abs(m["log_prior"][ci] - np.log(len(sub) / len(pdf))) < 1e-12


def test_fourier_features_approximate_rbf_kernel(spark):
    fm = M.FourierMap(d=4, n_components=4096, gamma=0.5, seed=1)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(6, 4))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "i int, a array<double>")
    z = np.array(df.select("i", fm.column(F.col("a")).alias("z")).orderBy("i").toPandas()["z"].tolist())
    k_hat = z @ z.T
    k = np.exp(-0.5 * ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    assert np.max(np.abs(k_hat - k)) < 0.08

