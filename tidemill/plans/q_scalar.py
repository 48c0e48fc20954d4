"""Registered queries: scalar and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.exprs import date_parts, ratio
from tidemill.operators.signal import array_mean
from tidemill.plans.catalog import query
from tidemill.plans.common import r6
from tidemill.sources.tables import read_table


@query("f1_arithmetic_features", sql="""
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS revenue,
  round(l_extendedprice - l_quantity, 6) AS spread, round(l_extendedprice / (l_quantity + 1e-8), 6) AS unit_price,
  round((l_discount + 1e-8) / (l_tax + 1e-8), 6) AS discount_tax_ratio, round(l_quantity * l_tax, 6) AS interaction
FROM lineitem""")
def f1_arithmetic_features(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        r6(F.col("l_extendedprice") - F.col("l_quantity")).alias("spread"),
        r6(ratio("l_extendedprice", "l_quantity")).alias("unit_price"),
        r6(ratio("l_discount", "l_tax", both=True)).alias("discount_tax_ratio"),
        r6(F.col("l_quantity") * F.col("l_tax")).alias("interaction"))


@query("f2_date_parts", sql="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
  CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year FROM orders""")
def f2_date_parts(spark, sf):
    o = read_table(spark, sf, "orders")
    parts = date_parts(F.col("o_orderdate"))
    return o.select("o_orderkey", *[c.cast("int").alias(n) if n != "year" else c.alias(n) for n, c in parts.items()])


@query("f3_date_parse", sql="""
SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderkey % 10 = 3 THEN strftime(o_orderdate, '%Y-%m-%d') || 'x'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS order_date FROM orders""")
def f3_date_parse(spark, sf):
    o = read_table(spark, sf, "orders")
    txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    txt = F.when(F.col("o_orderkey") % 10 == 3, F.concat(txt, F.lit("x"))).otherwise(txt)
    return o.select("o_orderkey", F.try_to_timestamp(txt, F.lit("yyyy-MM-dd")).cast("date").alias("order_date"))


@query("f4_string_tests", sql="""
SELECT page_id, lower(url) AS url_lower, CAST(contains(lower(url), '/en/') AS INTEGER) AS is_en,
  substr(url, 1, 5) AS scheme_head, CAST(regexp_matches(url, 'example\\.(org|net)') AS INTEGER) AS org_or_net
FROM pages""")
def f4_string_tests(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", F.lower("url").alias("url_lower"),
                    F.contains(F.lower("url"), F.lit("/en/")).cast("int").alias("is_en"),
                    F.substring("url", 1, 5).alias("scheme_head"),
                    F.col("url").rlike(r"example\.(org|net)").cast("int").alias("org_or_net"))


@query("f5_numeric_functions", sql="""
SELECT vec_id, round(list_avg(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS mean_value,
  round(abs(CAST(embedding[1] AS DOUBLE)), 6) AS abs_first, round(sqrt(abs(CAST(embedding[1] AS DOUBLE))), 6) AS sqrt_abs_first,
  round(CAST(embedding[2] AS DOUBLE) * CAST(embedding[2] AS DOUBLE), 6) AS square_second FROM embeddings""")
def f5_numeric_functions(spark, sf):
    e = read_table(spark, sf, "embeddings")
    a, b = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    return e.select("vec_id", r6(array_mean(F.col("embedding"))).alias("mean_value"), r6(F.abs(a)).alias("abs_first"),
                    r6(F.sqrt(F.abs(a))).alias("sqrt_abs_first"), r6(b * b).alias("square_second"))


@query("f6_array_functions", sql="""
SELECT vec_id, list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE)) AS head4,
  list_transform(list_concat(embedding[1:2], embedding[63:64]), lambda x: CAST(x AS DOUBLE)) AS ends,
  CAST(len(flatten([embedding[1:32], embedding[33:64]])) AS INTEGER) AS n_flat FROM embeddings""")
def f6_array_functions(spark, sf):
    e = read_table(spark, sf, "embeddings")
    emb = F.transform("embedding", lambda v: v.cast("double"))
    return e.select("vec_id", F.slice(emb, 1, 4).alias("head4"),
                    F.concat(F.slice(emb, 1, 2), F.slice(emb, 63, 2)).alias("ends"),
                    F.size(F.flatten(F.array(F.slice(emb, 1, 32), F.slice(emb, 33, 32)))).alias("n_flat"))
