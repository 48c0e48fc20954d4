"""Registered queries: models.

Exact estimators with a closed form in SQL are checked against DuckDB (M1 with one
feature, M4 kNN, M10 naive Bayes); the others return predictions or coefficient
tables and are checked in the test suite against NumPy closed forms or invariants.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemill.operators import boosting as B
from tidemill.operators import forest as FO
from tidemill.operators import kernel_svm as S
from tidemill.operators import models as M
from tidemill.operators import trees as TR
from tidemill.operators.bayes import fit_gaussian_nb, predict_gaussian_nb
from tidemill.operators.knn import knn_classify
from tidemill.operators.sampling import stratified_split
from tidemill.plans.catalog import query
from tidemill.plans.common import EMB_COLS, duck_h, emb, emb_sql, rk
from tidemill.session import cut_lineage

ES = EMB_COLS


def reg_target():
    return 3 * F.col("e1") - 2 * F.col("e2") + F.col("e3") * F.col("e3")

REG_TARGET_SQL = "3 * e1 - 2 * e2 + e3 * e3"

SPLIT_SQL = f"""(SELECT *, CASE WHEN row_number() OVER (PARTITION BY y3 ORDER BY {duck_h('vec_id')}, vec_id)
    <= round(count(*) OVER (PARTITION BY y3) * 0.2) THEN 'test' ELSE 'train' END AS split FROM {emb_sql()})"""


def split_emb(spark, sf):
    d = stratified_split(emb(spark, sf), "vec_id", "y3", 0.2)
    return d.withColumn("target", reg_target())


def _xy(spark, sf, label="y3"):
    d = split_emb(spark, sf)
    va = M.assembler(ES)
    return va.transform(d).withColumn("label", F.col(label).cast("double"))


def _train_test(spark, sf, label="y3"):
    d = cut_lineage(_xy(spark, sf, label))
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


@query("m1_least_squares", sql=f"""
SELECT round(regr_intercept({REG_TARGET_SQL}, e1), 6) AS intercept, round(regr_slope({REG_TARGET_SQL}, e1), 6) AS slope
FROM {emb_sql()}""")
def m1_least_squares(spark, sf):
    d = M.assembler(["e1"]).transform(emb(spark, sf).withColumn("label", reg_target()))
    model = M.least_squares().fit(d)
    return spark.range(1).select(rk(F.lit(model.intercept), 6).alias("intercept"),
                                 rk(F.lit(float(model.coefficients[0])), 6).alias("slope"))


def _coef_rows(spark, model, cols):
    rows = [("intercept", float(model.intercept))] + M.coefficient_table(model, cols)
    return spark.createDataFrame(rows, "term string, coefficient double")


@query("m1_least_squares_multi")
def m1_least_squares_multi(spark, sf):
    tr, _ = _train_test(spark, sf, "target")
    return _coef_rows(spark, M.least_squares().fit(tr), ES)


@query("m2_ridge")
def m2_ridge(spark, sf):
    tr, _ = _train_test(spark, sf, "target")
    st = tr.agg(F.stddev_pop("label").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return _coef_rows(spark, M.ridge(1.0, st["s"], st["n"]).fit(tr), ES)


@query("m3_lasso")
def m3_lasso(spark, sf):
    tr, _ = _train_test(spark, sf, "target")
    return _coef_rows(spark, M.lasso(0.001).fit(tr), ES)


@query("m4_knn", sql=f"""
WITH t AS {SPLIT_SQL},
tr AS (SELECT * FROM t WHERE split = 'train'), te AS (SELECT * FROM t WHERE split = 'test'),
d AS (SELECT te.vec_id AS qid, tr.vec_id AS tid, tr.y3 AS y, sqrt({' + '.join(f'(te.{c} - tr.{c}) * (te.{c} - tr.{c})' for c in ES)}) AS dist
      FROM te CROSS JOIN tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS r FROM d) WHERE r <= 5),
v AS (SELECT qid, y, count(*) AS votes FROM nn GROUP BY qid, y)
SELECT qid AS vec_id, CAST(y AS DOUBLE) AS prediction, votes / 5.0 AS vote_share FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, y) AS r FROM v) WHERE r = 1""")
def m4_knn(spark, sf):
    d = cut_lineage(split_emb(spark, sf))  # read by the block builders and their counts
    tr, te = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    return knn_classify(tr, te, ES, "y3", "vec_id", "vec_id", k=5)


@query("m5_logistic")
def m5_logistic(spark, sf):
    tr, te = _train_test(spark, sf)
    model = M.logistic(1.0, tr.count()).fit(tr)
    return model.transform(te).select("vec_id", "label", "prediction",
                                      vector_to_array("probability").alias("probability"))


_NB_TERMS = " ".join(f"- 0.5 * ln(2 * pi() * v_{c}) - ({c} - m_{c}) * ({c} - m_{c}) / (2 * v_{c})" for c in ES)


@query("m10_gaussian_nb", sql=f"""
WITH t AS {SPLIT_SQL}, tr AS (SELECT * FROM t WHERE split = 'train'),
ov AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in ES)}) AS eps FROM tr),
cs AS (SELECT y3 AS c, ln(count(*) / (SELECT count(*) FROM tr)) AS lp,
         {', '.join(f'avg({c}) AS m_{c}, var_pop({c}) + any_value(eps) AS v_{c}' for c in ES)}
       FROM tr, ov GROUP BY y3),
sc AS (SELECT vec_id, c, lp {_NB_TERMS} AS s FROM t CROSS JOIN cs WHERE split = 'test')
SELECT vec_id, c AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) AS r FROM sc)
WHERE r = 1""")
def m10_gaussian_nb(spark, sf):
    d = cut_lineage(split_emb(spark, sf))
    model = fit_gaussian_nb(d.where(F.col("split") == "train"), ES, "y3")
    return predict_gaussian_nb(d.where(F.col("split") == "test"), model).select("vec_id", "prediction")


def _fit_predict(spark, sf, est, label="y3"):
    tr, te = _train_test(spark, sf, label)
    return est.fit(tr).transform(te)


@query("m6_decision_tree")
def m6_decision_tree(spark, sf):
    """Exact Gini tree to purity, scored on the test split."""
    tr, te = kernel_split(spark, sf)
    p = TR.fit_tree(tr, ES, "y3").predict(te)
    return p.select("vec_id", F.col("y3").cast("double").alias("label"), "prediction")


@query("m6_training_fit", sql=f"""
SELECT count(*) AS n_rows, count(*) AS correct FROM {SPLIT_SQL} WHERE split = 'train'""")
def m6_training_fit(spark, sf):
    """A tree grown to purity is right on all its training rows (no two are alike)."""
    tr, _ = kernel_split(spark, sf)
    p = TR.fit_tree(tr, ES, "y3").predict(tr)
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("prediction") == F.col("y3")).cast("long")).alias("correct"))


_LONG_SQL = f"""t AS (SELECT vec_id, y3, [{', '.join(ES)}] AS x FROM {SPLIT_SQL} WHERE split = 'train'),
l AS (SELECT vec_id, y3, unnest(range(64)) AS j, unnest(x) AS v FROM t)"""
_SCORE_SQL = ("(l0 * l0 + l1 * l1 + l2 * l2) / (l0 + l1 + l2) + ((a0 - l0) * (a0 - l0) + (a1 - l1) * (a1 - l1) + (a2 - l2) * (a2 - l2)) "
              "/ (a0 + a1 + a2 - l0 - l1 - l2)")


def _exact_sql(rows: str, name: str) -> str:
    """Best split per node of ``rows`` (node, vec_id)."""
    sums = ", ".join(f"CAST(sum(c{c}) OVER (PARTITION BY node, j ORDER BY v) AS DOUBLE) AS l{c}, CAST(sum(c{c}) OVER (PARTITION BY node, j) AS DOUBLE) AS a{c}" for c in range(3))
    return f"""{name}_n AS (SELECT node, j, v, {', '.join(f'count(*) FILTER (WHERE y3 = {c}) AS c{c}' for c in range(3))} FROM {rows} JOIN l USING (vec_id) GROUP BY node, j, v),
{name}_s AS (SELECT node, j, v, {sums}, lead(v) OVER (PARTITION BY node, j ORDER BY v) AS w FROM {name}_n),
{name}_c AS (SELECT node, j, CASE WHEN (v + w) / 2 < w THEN (v + w) / 2 ELSE v END AS threshold, {_SCORE_SQL} AS score, l0 + l1 + l2 AS n_left,
  a0 + a1 + a2 - l0 - l1 - l2 AS n_right FROM {name}_s WHERE w IS NOT NULL AND greatest(a0, a1, a2) < a0 + a1 + a2),
{name} AS (SELECT * FROM {name}_c QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, j, threshold) = 1)"""


@query("m6_first_splits", sql=f"""
WITH {_LONG_SQL}, r AS (SELECT CAST(1 AS BIGINT) AS node, vec_id FROM t), {_exact_sql('r', 'root')},
k AS (SELECT CASE WHEN l.v <= threshold THEN 2 ELSE 3 END AS node, l.vec_id FROM root JOIN l USING (j)), {_exact_sql('k', 'kids')}
SELECT node, 'e' || (j + 1) AS feature, round(threshold, 6) AS threshold, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right
FROM (SELECT * FROM root UNION ALL SELECT * FROM kids)""")
def m6_first_splits(spark, sf):
    """Root and children of the exact tree."""
    tr, _ = kernel_split(spark, sf)
    rows = [r[1:] for r in TR.split_table(TR.fit_tree(tr, ES, "y3", max_depth=2), 2)]
    d = spark.createDataFrame(rows, "node long, feature string, threshold double, n_left long, n_right long")
    return d.withColumn("threshold", rk("threshold", 6))


@query("m7_random_forest")
def m7_random_forest(spark, sf):
    d = split_emb(spark, sf).withColumn("label", F.col("y3").cast("double"))
    from tidemill.operators.sampling import balanced_weights

    d = cut_lineage(balanced_weights(d, "label"))
    tr, te = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    p = FO.fit_forest(tr, ES, "label", ["vec_id"], trees=400, max_depth=30, weight="weight").predict(te, ["vec_id"])
    return te.select("vec_id", "label").join(p, "vec_id").select("vec_id", "label", "prediction")


@query("m8_random_forest_regressor")
def m8_random_forest_regressor(spark, sf):
    tr, te = kernel_split(spark, sf)
    p = FO.fit_forest(tr, ES, "target", ["vec_id"], trees=200, max_depth=30, max_bins=32, regression=True).predict(te, ["vec_id"])
    return te.select("vec_id", F.col("target").alias("label")).join(p, "vec_id")


@query("m9_gradient_boosting")
def m9_gradient_boosting(spark, sf):
    p = _fit_predict(spark, sf, M.gradient_boosting(max_iter=100, depth=3), "ring")
    return p.select("vec_id", "label", "prediction", vector_to_array("probability")[1].alias("score"))


def kernel_split(spark, sf):
    """The split rows, stored once: fits read them many times."""
    d = cut_lineage(split_emb(spark, sf))
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


@query("m11_rbf_svc")
def m11_rbf_svc(spark, sf):
    """Kernel classifier, balanced classes, with a probability calibrated on cross-fitted scores."""
    tr, te = kernel_split(spark, sf)
    gamma = M.gamma_scale(tr, ES)
    model, scores = S.fit_svc_and_scores(tr, ES, "ring", "vec_id", gamma, 1.0, balanced=True)
    curve = S.fit_sigmoid(cut_lineage(scores), "score", "ring")
    p = model.predict(te, "vec_id").join(te.select("vec_id", F.col("ring").cast("double").alias("label")), "vec_id")
    return p.select("vec_id", "label", "prediction", curve.column(F.col("score")).alias("probability"))


_PAIRS_SQL = """(SELECT * FROM (VALUES (0, 1), (0, 2), (1, 2)) AS p(low, high))"""


@query("m11_svc_optimality", sql=f"""
WITH t AS (SELECT * FROM {SPLIT_SQL} WHERE split = 'train')
SELECT CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, (SELECT count(*) FROM t WHERE y3 IN (low, high)) AS n_rows,
  CAST(0 AS DOUBLE) AS violation, CAST(0 AS DOUBLE) AS balance, CAST(0 AS BIGINT) AS outside FROM {_PAIRS_SQL}""")
def m11_svc_optimality(spark, sf):
    """Three classes, one against one: gradients of all rows, computed anew from the multipliers, miss optimality by nothing."""
    tr, _ = kernel_split(spark, sf)
    model = S.fit_svc(tr, ES, "y3", "vec_id", M.gamma_scale(tr, ES), 1.0, balanced=True)
    outs = [_optimality(d).select(F.lit(a).alias("low"), F.lit(b).alias("high"), "*") for (a, b), d in model.duals.items()]
    return reduce(lambda x, y: x.unionAll(y), outs)


def _optimality(dual):
    return S.optimality(dual).select(F.col("rows").alias("n_rows"), rk("violation", 2).alias("violation"), rk("balance", 6).alias("balance"), "outside")


@query("m11_calibration_gradient", sql="SELECT unnest(['slope', 'offset']) AS term, CAST(0 AS DOUBLE) AS gradient")
def m11_calibration_gradient(spark, sf):
    """The calibration's objective is flat at the fitted curve, over all cross-fitted scores."""
    tr, _ = kernel_split(spark, sf)
    scores = cut_lineage(S.cross_fitted_scores(tr, ES, "ring", "vec_id", M.gamma_scale(tr, ES)))
    curve = S.fit_sigmoid(scores, "score", "ring")
    d = S.smoothed_targets(scores, "ring") - curve.column(F.col("score"))
    g = scores.agg(F.sum(F.col("score") * d).alias("slope"), F.sum(d).alias("offset"))
    return g.unpivot([], ["slope", "offset"], "term", "g").select("term", (rk("g", 4) + F.lit(0.0)).alias("gradient"))


@query("m12_rbf_svr")
def m12_rbf_svr(spark, sf):
    tr, te = kernel_split(spark, sf)
    model = S.fit_svr(tr, ES, "target", "vec_id", M.gamma_scale(tr, ES), c=100.0, epsilon=0.1)
    return model.predict(te, "vec_id").join(te.select("vec_id", F.col("target").alias("label")), "vec_id").select("vec_id", "label", "prediction")


@query("m12_svr_optimality", sql=f"""
SELECT 2 * count(*) AS n_rows, CAST(0 AS DOUBLE) AS violation, CAST(0 AS DOUBLE) AS balance, CAST(0 AS BIGINT) AS outside
FROM {SPLIT_SQL} WHERE split = 'train'""")
def m12_svr_optimality(spark, sf):
    """Two multipliers a row, C = 100, epsilon = 0.1: as m11_svc_optimality."""
    tr, _ = kernel_split(spark, sf)
    return _optimality(S.fit_svr(tr, ES, "target", "vec_id", M.gamma_scale(tr, ES), c=100.0, epsilon=0.1).dual)


@query("m13_extra_trees")
def m13_extra_trees(spark, sf):
    tr, te = kernel_split(spark, sf)
    p = TR.fit_extra_trees(tr, ES, "ring", trees=100).predict(te)
    return p.select("vec_id", F.col("ring").cast("double").alias("label"), "probability", "prediction")


def _drawn_sql(rows: str, name: str) -> str:
    """Best of the eight drawn thresholds per tree and node of ``rows`` (tree, node, vec_id)."""
    sides = ", ".join(f"CAST(count(*) FILTER (WHERE y3 = {c} AND v <= threshold) AS DOUBLE) AS l{c}, CAST(count(*) FILTER (WHERE y3 = {c}) AS DOUBLE) AS a{c}" for c in range(3))
    return f"""{name}_d AS (SELECT tree, node, j, row_number() OVER (PARTITION BY tree, node ORDER BY md5(tree || '|' || node || '|' || j || '|42')) AS place
  FROM (SELECT DISTINCT tree, node FROM {rows}), (SELECT unnest(range(64)) AS j) QUALIFY place <= 8),
{name}_r AS (SELECT tree, node, j, place, min(v) AS lo, max(v) AS hi FROM {rows} JOIN {name}_d USING (tree, node) JOIN l USING (vec_id, j) GROUP BY ALL),
{name}_t AS (SELECT *, lo + CAST('0x' || substr(md5(tree || '|' || node || '|' || j || '|cut|42'), 1, 8) AS BIGINT) / 4294967296.0 * (hi - lo) AS threshold
  FROM {name}_r WHERE lo < hi),
{name}_c AS (SELECT tree, node, j, place, threshold, {sides} FROM {rows} JOIN {name}_t USING (tree, node) JOIN l USING (vec_id, j) GROUP BY ALL),
{name} AS (SELECT tree, node, j, threshold, l0 + l1 + l2 AS n_left, a0 + a1 + a2 - l0 - l1 - l2 AS n_right FROM {name}_c WHERE greatest(a0, a1, a2) < a0 + a1 + a2
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY {_SCORE_SQL} DESC, place) = 1)"""


@query("m13_first_levels", sql=f"""
WITH {_LONG_SQL}, r AS (SELECT tree, CAST(1 AS BIGINT) AS node, vec_id FROM t, (SELECT unnest(range(20)) AS tree)), {_drawn_sql('r', 'root')},
k AS (SELECT tree, CAST(CASE WHEN l.v <= threshold THEN 2 ELSE 3 END AS BIGINT) AS node, l.vec_id FROM root JOIN l USING (j)), {_drawn_sql('k', 'kids')}
SELECT tree, node, 'e' || (j + 1) AS feature, round(threshold, 6) AS threshold, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right
FROM (SELECT * FROM root UNION ALL SELECT * FROM kids)""")
def m13_first_levels(spark, sf):
    """First two levels of twenty extremely randomised trees."""
    tr, _ = kernel_split(spark, sf)
    rows = TR.split_table(TR.fit_extra_trees(tr, ES, "y3", trees=20, max_depth=2), 2)
    d = spark.createDataFrame(rows, "tree long, node long, feature string, threshold double, n_left long, n_right long")
    return d.withColumn("threshold", rk("threshold", 6))


def _boost_sql(rows: str, name: str) -> str:
    """Best split per class and node of ``rows`` (c, node, vec_id), and ``name``_k: the rows in the children."""
    return f"""{name}_c AS (SELECT c, node, j, v, count(*) AS n, count(*) FILTER (WHERE y3 = c) AS a FROM {rows} JOIN u USING (vec_id) JOIN t USING (vec_id) GROUP BY ALL),
{name}_s AS (SELECT c, node, j, v, sum(n) OVER w AS nl, sum(a) OVER w AS al, sum(n) OVER g AS n, sum(a) OVER g AS a, lead(v) OVER w AS nxt FROM {name}_c
  WINDOW w AS (PARTITION BY c, node, j ORDER BY v), g AS (PARTITION BY c, node, j)),
{name}_g AS (SELECT c, node, j, (v + nxt) / 2 AS threshold, pow(al - nl * p, 2) / nl + pow((a - al) - (n - nl) * p, 2) / (n - nl) AS score, pow(a - n * p, 2) / n AS whole
  FROM {name}_s JOIN p USING (c) WHERE nxt IS NOT NULL),
{name} AS (SELECT c, node, j, threshold FROM (SELECT *, max(score) OVER (PARTITION BY c, node) AS top FROM {name}_g)
  WHERE score >= top * (1 - 1e-12) AND top > whole + 1e-9 QUALIFY row_number() OVER (PARTITION BY c, node ORDER BY j, threshold) = 1),
{name}_k AS (SELECT r.c, CASE WHEN s.j IS NULL THEN r.node WHEN u.v <= s.threshold THEN 2 * r.node ELSE 2 * r.node + 1 END AS node, r.vec_id
  FROM {rows} r LEFT JOIN {name} s ON s.c = r.c AND s.node = r.node LEFT JOIN u ON u.vec_id = r.vec_id AND u.j = s.j)"""


def steps_of_64(df):
    """Features in whole 64ths, so that every midpoint is a candidate."""
    return df.withColumns({c: F.floor(F.col(c) * 64) / F.lit(64.0) for c in ES})


@query("m9_first_round", sql=f"""
WITH {_LONG_SQL}, u AS (SELECT vec_id, j, floor(v * 64) / 64.0 AS v FROM l), p AS (SELECT y3 AS c, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM t) AS p FROM t GROUP BY 1),
r AS (SELECT c, CAST(1 AS BIGINT) AS node, vec_id FROM p, t), {_boost_sql('r', 'one')}, {_boost_sql('one_k', 'two')}
SELECT CAST(c AS DOUBLE) AS class, node AS leaf, count(*) AS n_rows,
  round(2 / 3.0 * (count(*) FILTER (WHERE y3 = c) - count(*) * any_value(p)) / (count(*) * any_value(p) * (1 - any_value(p))), 6) AS value
FROM two_k JOIN t USING (vec_id) JOIN p USING (c) GROUP BY c, node""")
def m9_first_round(spark, sf):
    """Leaves of the first round, three classes, two levels: exact splits and second-order values."""
    tr, _ = kernel_split(spark, sf)
    model = B.fit_boosting(steps_of_64(tr), ES, "y3", rounds=1, depth=2, max_bins=1024)
    d = spark.createDataFrame(B.leaf_table(model, 0), "class double, leaf long, n_rows long, value double")
    return d.withColumn("value", rk("value", 6))


@query("m9_boosted_classes")
def m9_boosted_classes(spark, sf):
    """Three classes, Newton leaves, 100 rounds of depth 3."""
    tr, te = kernel_split(spark, sf)
    p = B.fit_boosting(tr, ES, "y3").predict(te)
    return p.select("vec_id", F.col("y3").cast("double").alias("label"), "probability", "prediction")


@query("m14_feature_importance")
def m14_feature_importance(spark, sf):
    tr, _ = kernel_split(spark, sf)
    model = FO.fit_forest(tr, ES, "ring", ["vec_id"], trees=400, max_depth=30)
    return spark.createDataFrame(M.importance_rows(model.importances(), ES, 10), "feature string, importance double")


@query("m15_coefficient_table")
def m15_coefficient_table(spark, sf):
    tr, _ = _train_test(spark, sf, "target")
    model = M.least_squares().fit(tr)
    rows = M.coefficient_table(model, ES)
    return spark.createDataFrame(rows, "feature string, coefficient double").withColumn(
        "abs_coefficient", F.abs("coefficient"))


@query("m16_score_signal")
def m16_score_signal(spark, sf):
    tr, te = _train_test(spark, sf, "ring")
    p = M.logistic(1.0, tr.count()).fit(tr).transform(te)
    return p.select("vec_id", "label", M.score_signal(p).alias("score"))
