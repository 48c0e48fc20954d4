"""Registered queries: profiling aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import profile
from tidemill.operators.evaluate import best_by
from tidemill.plans.catalog import query
from tidemill.plans.common import EMB_COLS, CUSTOMER_NULLS_SQL, DAILY_SQL, customer_with_nulls, daily_orders, emb, emb_sql, r6, rk
from tidemill.sources.tables import read_table

LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _unpivot_sql(table: str, cols, extra: str = "") -> str:
    sel = ", ".join(cols)
    return f"(UNPIVOT (SELECT {extra}{sel} FROM {table}) ON {sel} INTO NAME feature VALUE v)"


@query("a1_describe", sql=f"""
SELECT feature, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
  round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM {_unpivot_sql('lineitem', LI_COLS)} GROUP BY feature""")
def a1_describe(spark, sf):
    d = profile.describe(read_table(spark, sf, "lineitem"), LI_COLS)
    return d.select("feature", "count", *[r6(c).alias(c) for c in ("mean", "std")], "min",
                    *[r6(c).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("a2_shape", sql="""
SELECT 'lineitem' AS table_name, count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem""")
def a2_shape(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("lineitem").alias("table_name"), "n_rows", F.lit(len(li.columns)).cast("bigint").alias("n_columns"))


@query("a2_head", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity LIMIT 5""")
def a2_head(spark, sf):
    """A2: ``head(5)`` with an explicit total order (a distributed top-5)."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return li.orderBy("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity").limit(5)


@query("a3_null_counts", sql=f"""
SELECT feature, CAST(missing_count AS BIGINT) AS missing_count FROM (UNPIVOT (
  SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey, count(*) FILTER (WHERE c_name IS NULL) AS c_name,
         count(*) FILTER (WHERE c_nationkey IS NULL) AS c_nationkey,
         count(*) FILTER (WHERE c_acctbal IS NULL) AS c_acctbal,
         count(*) FILTER (WHERE c_mktsegment IS NULL) AS c_mktsegment FROM {CUSTOMER_NULLS_SQL})
  ON c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment INTO NAME feature VALUE missing_count)""")
def a3_null_counts(spark, sf):
    return profile.null_counts(customer_with_nulls(spark, sf))


@query("a4_class_counts", sql="""
SELECT r_name, CAST(count(c_custkey) AS BIGINT) AS count
FROM region LEFT JOIN (SELECT c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
                       WHERE c_acctbal > 9900) c ON c.n_regionkey = region.r_regionkey
GROUP BY r_name""")
def a4_class_counts(spark, sf):
    """Customers with a balance above 9900 per region; the region table is the class
    dictionary, so a region without such customers is kept with 0."""
    c = read_table(spark, sf, "customer").where(F.col("c_acctbal") > 9900)
    nation = read_table(spark, sf, "nation")
    region = read_table(spark, sf, "region")
    named = (c.join(nation, c.c_nationkey == nation.n_nationkey)
             .join(region, F.col("n_regionkey") == region.r_regionkey).select("r_name"))
    return profile.class_counts(named, "r_name", classes=region.select("r_name"))


@query("a5_rate", sql="""
SELECT round(avg(CAST(c_mktsegment = 'BUILDING' AS DOUBLE)) * 100, 6) AS rate_pct FROM customer""")
def a5_rate(spark, sf):
    r = profile.rate(read_table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING")
    return r.select(r6("rate_pct").alias("rate_pct"))


@query("a6_basic_stats", sql=f"""
WITH l AS {_unpivot_sql('part', ['p_retailprice', 'p_size'], '')},
m AS (SELECT feature, v AS mode FROM (SELECT feature, v, row_number() OVER (PARTITION BY feature
        ORDER BY count(*) DESC, v) AS rn FROM l GROUP BY feature, v) WHERE rn = 1)
SELECT feature, round(avg(v), 6) AS mean, round(median(v), 6) AS median, any_value(m.mode) AS mode,
  round(var_samp(v), 6) AS variance, round(stddev_samp(v), 6) AS stdev
FROM l JOIN m USING (feature) GROUP BY feature""")
def a6_basic_stats(spark, sf):
    p = read_table(spark, sf, "part").select(F.col("p_retailprice").cast("double"), F.col("p_size").cast("double"))
    s = profile.basic_stats(p, ["p_retailprice", "p_size"])
    return s.select("feature", *[r6(c).alias(c) for c in ("mean", "median")], "mode",
                    *[r6(c).alias(c) for c in ("variance", "stdev")])


@query("a7_skew_kurt", sql=f"""
SELECT feature, round(skewness(v), 6) AS skewness, round(kurtosis(v), 6) AS kurtosis
FROM {_unpivot_sql('lineitem', LI_COLS)} GROUP BY feature""")
def a7_skew_kurt(spark, sf):
    s = profile.skew_kurt(read_table(spark, sf, "lineitem"), LI_COLS)
    return s.select("feature", r6("skewness").alias("skewness"), r6("kurtosis").alias("kurtosis"))


ES = EMB_COLS


def _pairs_sql(cols, cond):
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if cond(i, j):
                parts.append(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS corr FROM t")
    return " UNION ALL ".join(parts)


@query("a8_corr_matrix", sql="""
WITH l AS (SELECT vec_id, unnest(range(1, 65)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT 'e' || a.j AS feature_1, 'e' || b.j AS feature_2, round(corr(a.v, b.v), 6) AS corr
FROM l a JOIN l b USING (vec_id) GROUP BY a.j, b.j""")
def a8_corr_matrix(spark, sf):
    c = profile.corr_long(emb(spark, sf), ES)
    return c.select("feature_1", "feature_2", r6("corr").alias("corr"))


@query("a9_corr_target", sql="""
SELECT feature, round(c, 6) AS corr, round(abs(c), 6) AS abs_corr FROM (
  SELECT 'l_quantity' AS feature, corr(l_quantity, l_extendedprice) AS c FROM lineitem UNION ALL
  SELECT 'l_discount', corr(l_discount, l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_tax', corr(l_tax, l_extendedprice) FROM lineitem)""")
def a9_corr_target(spark, sf):
    c = profile.corr_with_target(read_table(spark, sf, "lineitem"), LI_COLS, "l_extendedprice")
    return c.select("feature", r6("corr").alias("corr"), r6("abs_corr").alias("abs_corr"))


@query("a10_top_abs_pairs", sql=f"""
WITH t AS {emb_sql()}
SELECT feature_1, feature_2, round(abs(corr), 6) AS abs_corr FROM ({_pairs_sql(ES, lambda i, j: i < j)})
ORDER BY abs(corr) DESC, feature_1, feature_2 LIMIT 50""")
def a10_top_abs_pairs(spark, sf):
    t = profile.top_abs_pairs(emb(spark, sf), ES, 50)
    return t.select("feature_1", "feature_2", r6("abs_corr").alias("abs_corr"))


GROUPS = {"first_half": ES[:32], "second_half": ES[32:]}
_LIST = ", ".join(ES)


@query("a11_class_feature_stats", sql=f"""
WITH l AS (UNPIVOT (SELECT ring, {_LIST} FROM {emb_sql()})
           ON {_LIST} INTO NAME feature VALUE v)
SELECT CASE WHEN CAST(substr(feature, 2) AS INTEGER) <= 32 THEN 'first_half' ELSE 'second_half' END AS "group",
  feature, round(avg(v) FILTER (WHERE ring = 0), 6) AS neg_mean, round(avg(v) FILTER (WHERE ring = 1), 6) AS pos_mean,
  round(abs(avg(v) FILTER (WHERE ring = 1) - avg(v) FILTER (WHERE ring = 0)), 6) AS mean_difference_abs,
  round(stddev_samp(v) FILTER (WHERE ring = 0), 6) AS neg_std, round(stddev_samp(v) FILTER (WHERE ring = 1), 6) AS pos_std
FROM l GROUP BY feature""")
def a11_class_feature_stats(spark, sf):
    s = profile.class_feature_stats(emb(spark, sf), GROUPS, "ring")
    return s.select("group", "feature", *[r6(c).alias(c) for c in
                                          ("neg_mean", "pos_mean", "mean_difference_abs", "neg_std", "pos_std")])


@query("a13_histogram", sql="""
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 20)) AS BIGINT), 19) AS bin, lo, hi
      FROM lineitem, mm)
SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 20, 6) AS bin_start,
  round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 20, 6) AS bin_end, count(*) AS count
FROM b GROUP BY bin""")
def a13_histogram(spark, sf):
    h = profile.histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", 20)
    return h.select("bin", r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "count")


@query("a14_box_stats", sql=f"""
WITH l AS (UNPIVOT (SELECT ring, {_LIST} FROM {emb_sql()}) ON {_LIST} INTO NAME feature VALUE v),
q AS (SELECT feature, ring, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3 FROM l GROUP BY ALL)
SELECT feature, ring, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high
FROM l JOIN q USING (feature, ring) GROUP BY feature, ring, q1, median, q3""")
def a14_box_stats(spark, sf):
    b = profile.box_stats(emb(spark, sf), ES, "ring")
    return b.select("feature", "ring", *[r6(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


@query("a15_best_row", sql="""
SELECT n_name, round(total, 6) AS total FROM (
  SELECT n_name, sum(c_acctbal) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)
ORDER BY total DESC, n_name LIMIT 1""")
def a15_best_row(spark, sf):
    c = read_table(spark, sf, "customer")
    n = read_table(spark, sf, "nation")
    t = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.sum("c_acctbal").alias("total"))
    return best_by(t, "n_name", "total").select("n_name", r6("total").alias("total"))


@query("a16_cumsum_series", sql=f"""
SELECT o_orderpriority, order_day, round(sum(total) OVER (PARTITION BY o_orderpriority ORDER BY order_day
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cumsum FROM {DAILY_SQL}""")
def a16_cumsum_series(spark, sf):
    d = daily_orders(spark, sf)
    c = profile.cumulative_sum(d, "total", "order_day", partition_cols=["o_orderpriority"])
    return c.select("o_orderpriority", "order_day", rk("cumsum", 4).alias("cumsum"))


@query("a16_cumsum_global", sql="""
SELECT o_orderkey, CAST(sum(n) OVER (ORDER BY o_totalprice, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_lines
FROM (SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders)""")
def a16_cumsum_global(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    li = read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"))
    t = o.join(li, "o_orderkey", "left").fillna(0, ["n"])
    c = profile.cumulative_sum(t, "n", "o_totalprice", tie_cols=["o_orderkey"], out="cum_lines")
    return c.select("o_orderkey", F.col("cum_lines").cast("bigint").alias("cum_lines"))


@query("a18_distinct_count", sql="""
SELECT CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_unique FROM lineitem""")
def a18_distinct_count(spark, sf):
    return profile.distinct_count(read_table(spark, sf, "lineitem"), "l_partkey")
