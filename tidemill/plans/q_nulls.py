"""Registered queries on tables with nulls in keys, classes, order values and cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_uniform
from tidemill.operators import evaluate as EV
from tidemill.operators import profile
from tidemill.operators.blocked_series import blocked_fill, blocked_series_features
from tidemill.operators.sampling import oversample, oversample_target, stratified_split
from tidemill.operators.windows import chronological_split
from tidemill.plans.catalog import query
from tidemill.plans.common import (
    CUSTOMER_NULLS_SQL, MULTI_SQL, customer_with_nulls, duck_h, duck_u, emb, emb_sql, multiclass_preds, r6, rk,
)
from tidemill.sources.tables import read_table

SPARSE = [f"e{i}" for i in range(1, 13)]


def sparse_emb(spark, sf):
    """Twelve embedding columns in which each cell is null with probability 0.1."""
    cells = [F.when(hash_uniform("vec_id", 100 + i) >= 0.1, F.col(c)).alias(c) for i, c in enumerate(SPARSE)]
    return emb(spark, sf).select("vec_id", *cells)


SPARSE_SQL = "(SELECT vec_id, " + ", ".join(
    f"CASE WHEN {duck_u('vec_id', 100 + i)} >= 0.1 THEN {c} END AS {c}" for i, c in enumerate(SPARSE)) + f" FROM {emb_sql()})"


@query("l5_split_null_class", sql=f"""
SELECT c_custkey, c_mktsegment, CASE WHEN row_number() OVER (PARTITION BY c_mktsegment ORDER BY {duck_h('c_custkey')}, c_custkey)
  <= round(count(*) OVER (PARTITION BY c_mktsegment) * 0.2) THEN 'test' ELSE 'train' END AS split FROM {CUSTOMER_NULLS_SQL}""")
def l5_split_null_class(spark, sf):
    return stratified_split(customer_with_nulls(spark, sf), "c_custkey", "c_mktsegment").select("c_custkey", "c_mktsegment", "split")


@query("l6_split_null_series", sql=f"""
SELECT c_custkey, c_mktsegment, CASE WHEN row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey)
  <= floor(count(*) OVER (PARTITION BY c_mktsegment) * 0.8) THEN 'train' ELSE 'test' END AS split FROM {CUSTOMER_NULLS_SQL}""")
def l6_split_null_series(spark, sf):
    """Series cut into blocks of 40 rows, so that positions come from several partitions."""
    d = customer_with_nulls(spark, sf).select("c_custkey", "c_mktsegment")
    return chronological_split(d, "c_mktsegment", "c_custkey", 0.8, block_rows=40)


@query("l7_null_class", sql=f"""
WITH c AS (SELECT c_mktsegment, count(*) AS n FROM {CUSTOMER_NULLS_SQL} GROUP BY 1)
SELECT c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN (SELECT max(n) FROM c WHERE c_mktsegment IS DISTINCT FROM 'BUILDING') ELSE n END AS n
FROM c""")
def l7_null_class(spark, sf):
    d = customer_with_nulls(spark, sf)
    out = oversample(d, "c_custkey", "c_mktsegment", "BUILDING", oversample_target(d, "c_mktsegment", "BUILDING"))
    return out.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("a16_null_group", sql=f"""
SELECT c_custkey, c_mktsegment, round(sum(c_acctbal) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey), 4) AS cumsum
FROM {CUSTOMER_NULLS_SQL}""")
def a16_null_group(spark, sf):
    c = profile.cumulative_sum(customer_with_nulls(spark, sf), "c_acctbal", "c_custkey", ["c_mktsegment"], target_rows=40)
    return c.select("c_custkey", "c_mktsegment", rk("cumsum", 4).alias("cumsum"))


def _corr_sql(n):
    cols = SPARSE[:n]
    return " UNION ALL ".join(f"SELECT {n} AS width, '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS corr FROM t"
                              for i, a in enumerate(cols) for b in cols[i + 1:])


@query("a8_corr_nulls", sql=f"""
WITH t AS {SPARSE_SQL} SELECT width, feature_1, feature_2, round(corr, 6) AS corr FROM ({_corr_sql(8)} UNION ALL {_corr_sql(12)})""")
def a8_corr_nulls(spark, sf):
    d = sparse_emb(spark, sf)
    parts = [profile.corr_long(d, SPARSE[:n], upper_only=True).select(F.lit(n).alias("width"), "feature_1", "feature_2", r6("corr").alias("corr")) for n in (8, 12)]
    return parts[0].unionByName(parts[1])


@query("a9_corr_nulls", sql=f"""
WITH t AS {SPARSE_SQL} SELECT feature, round(c, 6) AS corr, round(abs(c), 6) AS abs_corr FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, corr({c}, e1) AS c FROM t" for c in SPARSE[1:])})""")
def a9_corr_nulls(spark, sf):
    c = profile.corr_with_target(sparse_emb(spark, sf), SPARSE, "e1")
    return c.select("feature", r6("corr").alias("corr"), r6("abs_corr").alias("abs_corr"))


_NAN = {"with_nan": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END", "empty": "CAST(NULL AS DOUBLE)"}


@query("a1_describe_nan", sql=" UNION ALL ".join(f"""
SELECT '{n}' AS feature, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
  round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max
FROM (SELECT {e} AS v FROM customer)""" for n, e in _NAN.items()))
def a1_describe_nan(spark, sf):
    """NaN counts as missing; a column without values has null statistics."""
    c = read_table(spark, sf, "customer")
    d = c.select(F.when(F.col("c_custkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("with_nan"),
                 F.lit(None).cast("double").alias("empty"))
    s = profile.describe(d, ["with_nan", "empty"])
    return s.select("feature", "count", *[r6(x).alias(x) for x in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("e6_report_fixed_classes", sql=f"""
WITH p AS {MULTI_SQL}, k AS (SELECT unnest([0, 1, 2, 7]) AS cls),
s AS (SELECT cls, (SELECT count(*) FROM p WHERE label = cls AND prediction = cls) AS tp,
        (SELECT count(*) FROM p WHERE label = cls) AS support, (SELECT count(*) FROM p WHERE prediction = cls) AS predicted FROM k)
SELECT cls, round(CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END, 6) AS precision,
  round(CASE WHEN support = 0 THEN 0 ELSE tp / support END, 6) AS recall,
  round(CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END, 6) AS f1, support FROM s""")
def e6_report_fixed_classes(spark, sf):
    s = EV.per_class_stats(multiclass_preds(spark, sf), classes=[0, 1, 2, 7])
    return s.select("cls", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("e5_confusion_nulls", sql=f"""
WITH p AS (SELECT CASE WHEN vec_id % 5 = 0 THEN NULL ELSE label END AS label, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE prediction END AS prediction
           FROM {MULTI_SQL}), k AS (SELECT label AS c FROM p UNION SELECT prediction FROM p)
SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM p WHERE p.label IS NOT DISTINCT FROM a.c AND p.prediction IS NOT DISTINCT FROM b.c) AS count
FROM k a CROSS JOIN k b""")
def e5_confusion_nulls(spark, sf):
    p = multiclass_preds(spark, sf)
    p = p.select(F.when(F.col("vec_id") % 5 != 0, F.col("label")).alias("label"), F.when(F.col("vec_id") % 7 != 0, F.col("prediction")).alias("prediction"))
    return EV.confusion_long(p)


_RUNS_SQL = "(SELECT c_custkey, c_nationkey % 3 AS series, CASE WHEN c_custkey % 90 >= 30 THEN c_acctbal END AS v FROM customer)"


def _runs(spark, sf):
    """Three series whose values are missing for 30 keys in a row, longer than any look-back."""
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", (F.col("c_nationkey") % 3).alias("series"), F.when(F.col("c_custkey") % 90 >= 30, F.col("c_acctbal")).alias("v"))


@query("w3_long_null_run", sql=f"""
WITH p AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur,
  last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {_RUNS_SQL})
SELECT c_custkey, series, round(CASE WHEN cur IS NULL OR prev IS NULL THEN 0 WHEN prev = 0 THEN NULL ELSE cur / prev - 1 END, 6) AS v_return FROM p""")
def w3_long_null_run(spark, sf):
    """Blocks of 15 rows: padding has to cross whole blocks without a value."""
    f = blocked_series_features(_runs(spark, sf), ["series"], "c_custkey", "v", ma=(5,), vol=(5,), block_rows=15)
    return f.select("c_custkey", "series", r6("v_return").alias("v_return"))


@query("c6_fill_long_null_run", sql=f"""
SELECT c_custkey, series, round(coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY c_custkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS v_filled FROM {_RUNS_SQL}""")
def c6_fill_long_null_run(spark, sf):
    f = blocked_fill(_runs(spark, sf), ["series"], "c_custkey", "v", block_rows=15)
    return f.select("c_custkey", "series", r6("v_filled").alias("v_filled"))
