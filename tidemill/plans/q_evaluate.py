"""Registered queries: evaluation and model comparison (E1-ES) on fixed-rule
predictions, so Spark and DuckDB score the very same prediction table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import evaluate as EV
from tidemill.operators.profile import histogram
from tidemill.plans.catalog import query
from tidemill.plans.common import MULTI_SQL, SCORED_SQL, multiclass_preds, r6, rk, scored_docs
from tidemill.sources.tables import read_table
from tidemill.session import cut_lineage


@query("e1_accuracy", sql=f"""
SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM {MULTI_SQL}""")
def e1_accuracy(spark, sf):
    return EV.accuracy(multiclass_preds(spark, sf)).select(r6("accuracy").alias("accuracy"))


@query("e2_binary_prf", sql=f"""
WITH c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn
  FROM {SCORED_SQL})
SELECT round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM c""")
def e2_binary_prf(spark, sf):
    m = EV.binary_prf(scored_docs(spark, sf))
    return m.select(*[r6(c).alias(c) for c in m.columns])


_PER_CLASS_SQL = f"""p AS {MULTI_SQL},
cls AS (SELECT label AS c FROM p UNION SELECT prediction FROM p),
pc AS (SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS tp, count(*) FILTER (WHERE label = c) AS support,
         count(*) FILTER (WHERE prediction = c) AS predicted FROM cls, p GROUP BY c),
m AS (SELECT c, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
        CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
        CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1, support, tp FROM pc)"""


@query("e3_weighted_prf", sql=f"""
WITH {_PER_CLASS_SQL}
SELECT round(sum(precision * support) / sum(support), 6) AS weighted_precision,
  round(sum(recall * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM m""")
def e3_weighted_prf(spark, sf):
    m = EV.weighted_prf(multiclass_preds(spark, sf))
    return m.select(*[r6(c).alias(c) for c in m.columns])


@query("e4_macro_f1", sql=f"WITH {_PER_CLASS_SQL} SELECT round(avg(f1), 6) AS macro_f1 FROM m")
def e4_macro_f1(spark, sf):
    return EV.macro_f1(multiclass_preds(spark, sf)).select(r6("macro_f1").alias("macro_f1"))


@query("e5_confusion_matrix", sql=f"""
WITH p AS {MULTI_SQL}, cls AS (SELECT label AS c FROM p UNION SELECT prediction FROM p)
SELECT a.c AS label, b.c AS prediction,
  CAST((SELECT count(*) FROM p WHERE p.label = a.c AND p.prediction = b.c) AS BIGINT) AS count FROM cls a, cls b""")
def e5_confusion_matrix(spark, sf):
    return EV.confusion_long(multiclass_preds(spark, sf))


@query("e5_confusion_wide", sql=f"""
WITH p AS {MULTI_SQL}
SELECT label, CAST(count(*) FILTER (WHERE prediction = 0) AS BIGINT) AS "0",
  CAST(count(*) FILTER (WHERE prediction = 1) AS BIGINT) AS "1", CAST(count(*) FILTER (WHERE prediction = 2) AS BIGINT) AS "2"
FROM p GROUP BY label""")
def e5_confusion_wide(spark, sf):
    w = EV.confusion_wide(multiclass_preds(spark, sf))
    return w.select("label", *[F.col(c).cast("bigint").alias(c) for c in w.columns if c != "label"])


E6_SQL = f"""
WITH {_PER_CLASS_SQL}, n AS (SELECT sum(support) AS n, sum(tp) AS hits FROM m)
SELECT CAST(c AS VARCHAR) AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM m
UNION ALL SELECT 'accuracy', round(hits / n, 6), round(hits / n, 6), round(hits / n, 6), CAST(n AS BIGINT) FROM n
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m"""


@query("e6_classification_report", sql=E6_SQL)
def e6_classification_report(spark, sf):
    r = EV.classification_report(multiclass_preds(spark, sf))
    return r.select("row", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("e7_roc_auc", sql=f"""
WITH p AS {SCORED_SQL}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk
  FROM p),
c AS (SELECT count(*) FILTER (WHERE label = 1) AS np, count(*) FILTER (WHERE label <> 1) AS nn,
        sum(rk) FILTER (WHERE label = 1) AS sr FROM r)
SELECT round(CASE WHEN np > 0 AND nn > 0 THEN (sr - np * (np + 1) / 2.0) / (np * nn) END, 6) AS roc_auc FROM c""")
def e7_roc_auc(spark, sf):
    return EV.roc_auc(scored_docs(spark, sf)).select(r6("roc_auc").alias("roc_auc"))


@query("e8_roc_curve", sql=f"""
WITH p AS {SCORED_SQL}, s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
  count(*) FILTER (WHERE label <> 1) AS neg FROM p GROUP BY score),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s)
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT score, round(sum(neg) OVER (ORDER BY score DESC) / N, 6), round(sum(pos) OVER (ORDER BY score DESC) / P, 6)
FROM s, t""")
def e8_roc_curve(spark, sf):
    c = EV.roc_curve(scored_docs(spark, sf))
    return c.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("e8_roc_curve_dropped", sql=f"""
WITH p AS {SCORED_SQL}, s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
  count(*) FILTER (WHERE label <> 1) AS neg FROM p GROUP BY score),
c AS (SELECT NULL::DOUBLE AS score, 0::DOUBLE AS tps, 0::DOUBLE AS fps, 0 AS i
      UNION ALL SELECT score, sum(pos) OVER (ORDER BY score DESC), sum(neg) OVER (ORDER BY score DESC),
        row_number() OVER (ORDER BY score DESC) FROM s),
d AS (SELECT *, lag(tps) OVER (ORDER BY i) AS tp0, lag(fps) OVER (ORDER BY i) AS fp0,
        lead(tps) OVER (ORDER BY i) AS tp2, lead(fps) OVER (ORDER BY i) AS fp2 FROM c),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s)
SELECT score AS threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr FROM d, t
WHERE tp0 IS NULL OR tp2 IS NULL OR tp2 - 2 * tps + tp0 <> 0 OR fp2 - 2 * fps + fp0 <> 0""")
def e8_roc_curve_dropped(spark, sf):
    c = EV.roc_curve(scored_docs(spark, sf), drop_intermediate=True)
    return c.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


_REG_SQL = """(SELECT o_orderkey, o_totalprice AS label, coalesce(p, 0) AS prediction FROM orders LEFT JOIN (
  SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS p FROM lineitem GROUP BY l_orderkey)
  ON l_orderkey = o_orderkey)"""


def _reg_preds(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("label"))
    li = read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("prediction"))
    return o.join(li, "o_orderkey", "left").fillna(0.0, ["prediction"])


@query("e9_regression_metrics", sql=f"""
SELECT count(*) AS n, round(avg(abs(label - prediction)), 4) AS mae, round(avg((label - prediction) ^ 2), 2) AS mse,
  round(sqrt(avg((label - prediction) ^ 2)), 4) AS rmse,
  round(1 - sum((label - prediction) ^ 2) / (var_pop(label) * count(*)), 6) AS r2,
  round(1 - (sum((label - prediction) ^ 2) / (var_pop(label) * count(*))) * (count(*) - 1) / (count(*) - 3 - 1), 6) AS adj_r2
FROM {_REG_SQL}""")
def e9_regression_metrics(spark, sf):
    m = EV.regression_metrics(_reg_preds(spark, sf), n_features=3)
    return m.select("n", rk("mae", 4).alias("mae"), rk("mse", 2).alias("mse"), rk("rmse", 4).alias("rmse"),
                    r6("r2").alias("r2"), r6("adj_r2").alias("adj_r2"))


@query("e11_residuals", sql=f"""
SELECT o_orderkey, round(prediction, 6) AS prediction, round(label - prediction, 6) AS residual FROM {_REG_SQL}""")
def e11_residuals(spark, sf):
    r = EV.residuals(_reg_preds(spark, sf))
    return r.select("o_orderkey", r6("prediction").alias("prediction"), r6("residual").alias("residual"))


@query("e11_residual_histogram", sql=f"""
WITH r AS (SELECT label - prediction AS e FROM {_REG_SQL}), mm AS (SELECT min(e) AS lo, max(e) AS hi FROM r),
b AS (SELECT least(CAST(floor((e - lo) / ((hi - lo) / 30)) AS BIGINT), 29) AS bin FROM r, mm)
SELECT bin, count(*) AS count FROM b GROUP BY bin""")
def e11_residual_histogram(spark, sf):
    h = histogram(EV.residuals(_reg_preds(spark, sf)), "residual", 30)
    return h.select("bin", "count")


_THRESH = {"rule_low": 0.3, "rule_mid": 0.5, "rule_high": 0.7}
_RULES_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, label, CAST(score > {t} AS INTEGER) AS prediction FROM {SCORED_SQL}" for m, t in _THRESH.items())


def _rule_preds(spark, sf):
    s = scored_docs(spark, sf)
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("t")) for m, t in _THRESH.items()])
    return s.select("label", "score", F.inline(arr)).select(
        "model", "label", (F.col("score") > F.col("t")).cast("int").alias("prediction"))


_RULE_METRICS_SQL = f"""(SELECT model, (tp + tn) / n AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1
  FROM (SELECT model, count(*) AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
    count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM ({_RULES_SQL}) GROUP BY model))"""


@query("e12_comparison_table", sql=f"""
SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(f1, 4) AS f1 FROM {_RULE_METRICS_SQL}""")
def e12_comparison_table(spark, sf):
    wide = EV.binary_metrics_by(_rule_preds(spark, sf), "model")
    long = EV.metrics_long(wide, ["model"])
    table = EV.comparison_table(long, metrics=["accuracy", "precision", "recall", "f1"])
    return table.orderBy(F.col("f1").desc(), F.col("accuracy").desc())


_NOISE = {"noise_0.25": 0.25, "noise_0.5": 0.5, "noise_1.0": 1.0}


def _multi_rules(spark, sf):
    from tidemill.plans.common import emb

    e = emb(spark, sf)
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(w).alias("w")) for m, w in _NOISE.items()])
    x = e.select("y3", "e1", "e2", "e3", "e4", "e5", "e6", F.inline(arr))
    a = [F.col("e1") + F.col("e4") * F.col("w"), F.col("e2") + F.col("e5") * F.col("w"),
         F.col("e3") + F.col("e6") * F.col("w")]
    pred = F.when((a[0] >= a[1]) & (a[0] >= a[2]), 0).when(a[1] >= a[2], 1).otherwise(2)
    return x.select("model", F.col("y3").alias("label"), pred.alias("prediction"))


def _multi_rules_sql():
    from tidemill.plans.common import emb_sql

    parts = []
    for m, w in _NOISE.items():
        a1, a2, a3 = f"e1 + e4 * {w}", f"e2 + e5 * {w}", f"e3 + e6 * {w}"
        parts.append(f"SELECT '{m}' AS model, y3 AS label, CASE WHEN {a1} >= {a2} AND {a1} >= {a3} THEN 0 "
                     f"WHEN {a2} >= {a3} THEN 1 ELSE 2 END AS prediction FROM {emb_sql()}")
    return " UNION ALL ".join(parts)


@query("e13_model_choice", sql=f"""
WITH p AS ({_multi_rules_sql()}),
cls AS (SELECT DISTINCT model, c FROM (SELECT model, label AS c FROM p UNION SELECT model, prediction FROM p)),
pc AS (SELECT cls.model, c, count(*) FILTER (WHERE label = c AND prediction = c) AS tp,
  count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE prediction = c) AS predicted
  FROM cls JOIN p USING (model) GROUP BY cls.model, c),
m AS (SELECT model, sum(tp) / sum(support) AS accuracy,
        avg(CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END) AS macro_f1 FROM pc GROUP BY model)
SELECT model, round(macro_f1, 6) AS macro_f1, round(accuracy, 6) AS accuracy FROM m
ORDER BY round(macro_f1, 8) DESC, accuracy DESC, model LIMIT 1""")
def e13_model_choice(spark, sf):
    m = EV.multiclass_metrics_by(_multi_rules(spark, sf), "model").withColumn("f1_r", rk("macro_f1", 8))
    best = EV.best_by(m, "model", "f1_r", "accuracy")
    return best.select("model", r6("macro_f1").alias("macro_f1"), r6("accuracy").alias("accuracy"))


@query("e16_gain_over_baseline", sql=f"""
WITH m AS {_RULE_METRICS_SQL}
SELECT round(f1, 6) AS candidate, round((SELECT f1 FROM m WHERE model = 'rule_mid'), 6) AS baseline,
  round(f1 - (SELECT f1 FROM m WHERE model = 'rule_mid'), 6) AS gain
FROM (SELECT * FROM m ORDER BY f1 DESC, model LIMIT 1)""")
def e16_gain_over_baseline(spark, sf):
    m = cut_lineage(EV.binary_metrics_by(_rule_preds(spark, sf), "model"))
    best = EV.best_by(m, "model", "f1")
    g = EV.gain_over(best, m.where(F.col("model") == "rule_mid"), "f1")
    return g.select(*[r6(c).alias(c) for c in ("candidate", "baseline", "gain")])
