"""Registered queries: cleaning (C1-C15) and the two implicit joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.exprs import keyword_flag, yes_flag
from tidemill.operators import clean
from tidemill.operators.windows import ffill_bfill_col, series_window
from tidemill.functions.hashing import hash_uniform
from tidemill.plans.catalog import query
from tidemill.plans.common import (
    CUSTOMER_NULLS_SQL, DAILY_SQL, DIRTY_CUSTOMER_SQL, customer_with_nulls, daily_orders, dirty_customer,
    duck_u, r6,
)
from tidemill.sources.tables import read_table

# Fixed values (must equal the reference): image-name tokens that mark the positive class,
# class id -> gesture name, class id -> prosthetic action.
PNEUMONIA_TOKENS = ["person", "pneumonia", "bacteria", "virus"]
GESTURE_NAMES = {0: "Rock", 1: "Scissors", 2: "Paper", 3: "OK"}
PROSTHETIC_ACTIONS = {0: "Grip", 1: "Wrist Extension", 2: "Open Palm", 3: "Pinch"}


@query("c1_sentinel_null", sql=f"""
SELECT c_custkey, acct_text, CASE WHEN acct_text IN ('_', '') THEN NULL ELSE acct_text END AS acct_clean
FROM {DIRTY_CUSTOMER_SQL}""")
def c1_sentinel_null(spark, sf):
    d = dirty_customer(spark, sf).select("c_custkey", "acct_text", F.col("acct_text").alias("acct_clean"))
    return clean.replace_sentinels(d, ["acct_clean"])


@query("c2_coerce_cast", sql=f"""
SELECT c_custkey, acct_text, TRY_CAST(acct_text AS DOUBLE) AS acct_cents FROM {DIRTY_CUSTOMER_SQL}""")
def c2_coerce_cast(spark, sf):
    d = dirty_customer(spark, sf).select("c_custkey", "acct_text", F.col("acct_text").alias("acct_cents"))
    return clean.coerce_numeric(d, ["acct_cents"])


@query("c3_mean_impute", sql=f"""
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM {CUSTOMER_NULLS_SQL})), 6) AS c_acctbal
FROM {CUSTOMER_NULLS_SQL}""")
def c3_mean_impute(spark, sf):
    d = customer_with_nulls(spark, sf).select("c_custkey", "c_acctbal")
    return clean.impute_mean(d, ["c_acctbal"]).select("c_custkey", r6("c_acctbal").alias("c_acctbal"))


@query("c4_median_impute", sql=f"""
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT coalesce(quantile_cont(c_acctbal, 0.5), 0)
                                               FROM {CUSTOMER_NULLS_SQL})), 6) AS c_acctbal
FROM {CUSTOMER_NULLS_SQL}""")
def c4_median_impute(spark, sf):
    d = customer_with_nulls(spark, sf).select("c_custkey", "c_acctbal")
    return clean.impute_median(d, ["c_acctbal"]).select("c_custkey", r6("c_acctbal").alias("c_acctbal"))


@query("c5_mode_impute", sql=f"""
WITH t AS {CUSTOMER_NULLS_SQL},
m AS (SELECT c_mktsegment AS v FROM t WHERE c_mktsegment IS NOT NULL
      GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT c_custkey, coalesce(c_mktsegment, (SELECT v FROM m), 'Unknown') AS c_mktsegment FROM t""")
def c5_mode_impute(spark, sf):
    d = customer_with_nulls(spark, sf).select("c_custkey", "c_mktsegment")
    return clean.impute_mode(d, ["c_mktsegment"])


@query("c6_ffill_bfill", sql=f"""
WITH d AS (SELECT o_orderpriority, order_day,
             CASE WHEN {duck_u("o_orderpriority || '|' || CAST(order_day AS VARCHAR)")} < 0.2 THEN NULL
                  ELSE total END AS total
           FROM {DAILY_SQL})
SELECT o_orderpriority, order_day, total AS total_raw,
  round(coalesce(
    last_value(total IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY order_day
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(total IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY order_day
                                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS total_filled
FROM d""")
def c6_ffill_bfill(spark, sf):
    d = daily_orders(spark, sf)
    key = F.concat_ws("|", "o_orderpriority", F.col("order_day").cast("string"))
    d = d.select("o_orderpriority", "order_day",
                 F.when(hash_uniform(key) < 0.2, F.lit(None)).otherwise(F.col("total")).alias("total_raw"))
    w = series_window("o_orderpriority", "order_day")
    return d.withColumn("total_filled", r6(ffill_bfill_col("total_raw", w)))


@query("c7_dropna", sql=f"""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN {duck_u("l_orderkey * 10 + l_linenumber", 1)} < 0.05 THEN NULL ELSE l_discount END AS l_discount,
    CASE WHEN {duck_u("l_orderkey * 10 + l_linenumber", 2)} < 0.05 THEN NULL ELSE l_tax END AS l_tax
  FROM lineitem) WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL""")
def c7_dropna(spark, sf):
    li = read_table(spark, sf, "lineitem")
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    d = li.select("l_orderkey", "l_linenumber",
                  F.when(hash_uniform(k, 1) < 0.05, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
                  F.when(hash_uniform(k, 2) < 0.05, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"))
    return clean.drop_null_rows(d)


@query("c8_drop_duplicates", sql="""
SELECT DISTINCT * FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 50 = 0)""")
def c8_drop_duplicates(spark, sf):
    c = read_table(spark, sf, "customer")
    return clean.drop_duplicate_rows(c.unionByName(c.where(F.col("c_custkey") % 50 == 0)))


@query("c9_drop_rename", sql="""
SELECT p_partkey, p_brand, p_type, p_size, p_retailprice AS target FROM part""")
def c9_drop_rename(spark, sf):
    p = read_table(spark, sf, "part")
    p = clean.drop_if_present(p, ["p_name", "id", "Id"])
    return clean.rename_first_matching(p, "price", "target")


@query("c10_row_index", sql="""
SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey DESC) AS row_no FROM customer""")
def c10_row_index(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return clean.row_index(c, "c_acctbal", tie_cols=["c_custkey"], descending=True)


_IQR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_IQR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in _IQR_COLS)


@query("c11_iqr_outliers", sql=f"""
WITH l AS ({_IQR_SQL}),
q AS (SELECT feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM l GROUP BY feature),
b AS (SELECT feature, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT b.feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper,
  CAST(count(*) FILTER (WHERE v < lower OR v > upper) AS BIGINT) AS n_outliers
FROM l JOIN b USING (feature) GROUP BY ALL""")
def c11_iqr_outliers(spark, sf):
    li = read_table(spark, sf, "lineitem")
    out = clean.iqr_outliers(li, _IQR_COLS)
    return out.select("feature", *[r6(c).alias(c) for c in ("q1", "q3", "lower", "upper")], "n_outliers")


@query("c12_filter", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45""")
def c12_filter(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("c13_keyword_label", sql=f"""
SELECT doc_id, CAST({" OR ".join(f"contains(lower(text), '{w}')" for w in PNEUMONIA_TOKENS)} AS INTEGER) AS label
FROM documents""")
def c13_keyword_label(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", keyword_flag("text", PNEUMONIA_TOKENS).alias("label"))


@query("c14_binary_target", sql="""
SELECT c_custkey, CAST(coalesce(c_mktsegment = 'BUILDING', false) AS INTEGER) AS target FROM customer""")
def c14_binary_target(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", yes_flag("c_mktsegment", "BUILDING").alias("target"))


def _case_sql(col, mapping):
    return "CASE " + " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in mapping.items()) + " END"


@query("c15_code_map", sql=f"""
SELECT vec_id, label, {_case_sql('label', GESTURE_NAMES)} AS gesture,
  {_case_sql('label', PROSTHETIC_ACTIONS)} AS action FROM embeddings""")
def c15_code_map(spark, sf):
    e = read_table(spark, sf, "embeddings")
    g = F.create_map(*[x for k, v in GESTURE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    a = F.create_map(*[x for k, v in PROSTHETIC_ACTIONS.items() for x in (F.lit(k), F.lit(v))])
    return e.select("vec_id", "label", g[F.col("label")].alias("gesture"), a[F.col("label")].alias("action"))


@query("j1_aligned_divide", sql="""
WITH a AS (SELECT c_nationkey AS nationkey, sum(c_acctbal) AS cust_bal FROM customer
           WHERE c_mktsegment <> 'AUTOMOBILE' OR c_nationkey < 20 GROUP BY 1),
b AS (SELECT s_nationkey AS nationkey, sum(s_acctbal) AS supp_bal FROM supplier GROUP BY 1)
SELECT coalesce(a.nationkey, b.nationkey) AS nationkey, round(cust_bal, 6) AS cust_bal,
  round(supp_bal, 6) AS supp_bal, round(CASE WHEN supp_bal = 0 THEN NULL ELSE cust_bal / supp_bal END, 6) AS ratio
FROM a FULL OUTER JOIN b ON a.nationkey = b.nationkey""")
def j1_aligned_divide(spark, sf):
    c = read_table(spark, sf, "customer")
    s = read_table(spark, sf, "supplier")
    a = (c.where((F.col("c_mktsegment") != "AUTOMOBILE") | (F.col("c_nationkey") < 20))
         .groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.sum("c_acctbal").alias("cust_bal")))
    b = s.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.sum("s_acctbal").alias("supp_bal"))
    out = clean.aligned_divide(a, b, "nationkey", "cust_bal", "supp_bal")
    return out.select("nationkey", *[r6(x).alias(x) for x in ("cust_bal", "supp_bal", "ratio")])


@query("j2_keep_surviving", sql=f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM {CUSTOMER_NULLS_SQL} WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL)""")
def j2_keep_surviving(spark, sf):
    survivors = clean.drop_null_rows(customer_with_nulls(spark, sf)).select(F.col("c_custkey").alias("o_custkey"))
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return clean.keep_surviving(o, survivors, "o_custkey")
