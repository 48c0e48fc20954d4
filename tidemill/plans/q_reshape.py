"""Registered queries: reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators.evaluate import comparison_table, metrics_long
from tidemill.operators.profile import corr_long
from tidemill.plans.catalog import query
from tidemill.plans.common import EMB_COLS, emb, emb_sql, r6
from tidemill.sources.tables import read_table


@query("u2_melt", sql=f"""
SELECT vec_id, feature, v AS value FROM (UNPIVOT (SELECT vec_id, {", ".join(EMB_COLS)} FROM {emb_sql()})
  ON {", ".join(EMB_COLS)} INTO NAME feature VALUE v)""")
def u2_melt(spark, sf):
    e = emb(spark, sf).select("vec_id", *EMB_COLS)
    return e.unpivot(["vec_id"], EMB_COLS, "feature", "value")


_LCOLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("u3_stack_pairs", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_LCOLS) for j, b in enumerate(_LCOLS) if i < j))
def u3_stack_pairs(spark, sf):
    c = corr_long(read_table(spark, sf, "lineitem"), _LCOLS, upper_only=True)
    return c.select("feature_1", "feature_2", r6("corr").alias("corr"))


@query("u4_pivot_metrics", sql="""
SELECT c_mktsegment AS model, round(avg(c_acctbal), 4) AS mean_balance, round(max(c_acctbal), 4) AS max_balance,
  round(CAST(count(*) AS DOUBLE), 4) AS n_customers FROM customer GROUP BY c_mktsegment""")
def u4_pivot_metrics(spark, sf):
    c = read_table(spark, sf, "customer")
    wide = c.groupBy(F.col("c_mktsegment").alias("model")).agg(
        F.avg("c_acctbal").alias("mean_balance"), F.max("c_acctbal").alias("max_balance"),
        F.count(F.lit(1)).alias("n_customers"))
    long = metrics_long(wide, ["model"])
    return comparison_table(long, metrics=["mean_balance", "max_balance", "n_customers"])
