"""Registered queries that certify fitted models: quantities that are known in closed form at the
optimum, computed from the fitted model over all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemill.operators import cluster as K
from tidemill.operators import decompose as D
from tidemill.operators import kmeans as KM
from tidemill.operators import models as M
from tidemill.plans.catalog import query
from tidemill.plans.common import EMB_COLS, emb, emb_sql, r6, rk
from tidemill.plans.q_models import _train_test
from tidemill.session import cut_lineage

_ZEROS = " UNION ALL ".join(f"SELECT '{c}' AS term, CAST(0 AS DOUBLE) AS {{0}}" for c in EMB_COLS)


def _residual(model):
    fit = reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(c) for w, c in zip(model.coefficients, EMB_COLS)])
    return F.col("label") - fit - F.lit(float(model.intercept))


def _per_term(tr, model):
    """Mean of residual x feature, one row per feature."""
    wide = tr.withColumn("_r", _residual(model)).agg(*[F.avg(F.col("_r") * F.col(c)).alias(c) for c in EMB_COLS])
    return wide.unpivot([], EMB_COLS, "term", "g")


def _weights(spark, model):
    return F.element_at(F.create_map(*[x for w, c in zip(model.coefficients, EMB_COLS) for x in (F.lit(c), F.lit(float(w)))]), F.col("term"))


def _zero(c):
    """Rounded to four decimals, without a negative zero."""
    return rk(c, 4) + F.lit(0.0)


@query("m1_normal_equations", sql=_ZEROS.format("gradient"))
def m1_normal_equations(spark, sf):
    """Least squares: residuals are orthogonal to every feature."""
    tr, _ = _train_test(spark, sf, "target")
    return _per_term(tr, M.least_squares().fit(tr)).select("term", _zero("g").alias("gradient"))


@query("m2_ridge_optimality", sql=_ZEROS.format("gradient"))
def m2_ridge_optimality(spark, sf):
    """Ridge: mean(residual x feature) = alpha x weight / n."""
    tr, _ = _train_test(spark, sf, "target")
    st = tr.agg(F.stddev_pop("label").alias("s"), F.count(F.lit(1)).alias("n")).first()
    model = M.ridge(1.0, st["s"], st["n"]).fit(tr)
    return _per_term(tr, model).select("term", _zero(F.col("g") - _weights(spark, model) / F.lit(float(st["n"]))).alias("gradient"))


@query("m3_lasso_optimality", sql=_ZEROS.format("violation"))
def m3_lasso_optimality(spark, sf):
    """Lasso: |mean(residual x feature)| is alpha where the weight is not zero (with its sign), at most alpha elsewhere."""
    tr, _ = _train_test(spark, sf, "target")
    alpha = 0.001
    model = M.lasso(alpha).fit(tr)
    w = _weights(spark, model)
    off = F.when(w == 0, F.greatest(F.abs("g") - alpha, F.lit(0.0))).otherwise(F.abs(F.col("g") - F.signum(w) * alpha))
    return _per_term(tr, model).select("term", _zero(off).alias("violation"))


@query("t5_total_variance", sql=f"""
SELECT round({' + '.join(f'var_samp({c})' for c in EMB_COLS)}, 6) AS total_variance, CAST(1 AS DOUBLE) AS ratio_sum,
  CAST(0 AS DOUBLE) AS largest_covariance FROM {emb_sql()}""")
def t5_total_variance(spark, sf):
    """Principal components keep the total variance and are uncorrelated; ratios add up to one."""
    d = emb(spark, sf)
    fit = D.fit_pca(d, EMB_COLS)
    p = fit.transform(d)
    names = [f"p{i}" for i in range(len(EMB_COLS))]
    s = p.select(*[F.get("pca", F.lit(i)).alias(n) for i, n in enumerate(names)])
    agg = s.agg(*[F.var_samp(n).alias(f"v_{n}") for n in names], *[F.covar_samp(a, b).alias(f"c_{a}") for a, b in zip(names, names[1:])])
    total = reduce(lambda a, b: a + b, [F.col(f"v_{n}") for n in names])
    largest = F.greatest(*[F.abs(f"c_{n}") for n in names[:-1]])
    return agg.select(r6(total).alias("total_variance"), r6(F.lit(float(fit.explained.sum()))).alias("ratio_sum"), _zero(largest).alias("largest_covariance"))


@query("k1_fit_is_stable", sql="SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS cluster, false AS moved")
def k1_fit_is_stable(spark, sf):
    """One more Lloyd step from the fitted centroids moves none beyond the fit's tolerance."""
    d = cut_lineage(emb(spark, sf))
    centers = KM.fit(d, "vec_id", EMB_COLS, 3).centroids.tolist()
    step = K.lloyd_step(d, EMB_COLS, centers)
    far = [(F.col(c) - F.get(F.array(*[F.lit(x[j]) for x in centers]), F.col("cluster"))) ** 2 for j, c in enumerate(EMB_COLS)]
    return step.select("cluster", (F.sqrt(reduce(lambda a, b: a + b, far)) > 1e-3).alias("moved"))
