"""Registered queries: sorting, sampling, splitting, resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import sampling as S
from tidemill.operators.clean import inject_nulls_n
from tidemill.operators.profile import split_summary
from tidemill.operators.windows import chronological_split
from tidemill.sources.files import union_splits
from tidemill.plans.catalog import query
from tidemill.plans.common import DAILY_SQL, EMB_COLS, daily_orders, duck_h, duck_u, emb, emb_sql, r6
from tidemill.sources.tables import read_table


@query("l1_sort", sql="""
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem
ORDER BY l_returnflag, abs(l_extendedprice - 50000) DESC""")
def l1_sort(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return S.sort_rows(li, ["l_returnflag", F.abs(F.col("l_extendedprice") - 50000)], [True, False])


@query("l2_top_n", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def l2_top_n(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return S.top_n(o, 10, ["o_totalprice", "o_orderkey"], [False, True])


@query("l3_sample_n", sql=f"""
SELECT c_custkey, c_name FROM customer ORDER BY {duck_h('c_custkey')}, c_custkey LIMIT 100""")
def l3_sample_n(spark, sf):
    return S.sample_n(read_table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", 100)


@query("l3_sample_fraction", sql=f"""
SELECT o_orderkey FROM orders WHERE {duck_u('o_orderkey')} < 0.1""")
def l3_sample_fraction(spark, sf):
    return S.sample_fraction(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.1)


@query("l4_random_split", sql=f"""
SELECT o_orderkey, CASE WHEN {duck_u('o_orderkey')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM orders""")
def l4_random_split(spark, sf):
    return S.random_split(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2)


_STRAT_SQL = f"""(SELECT *, CASE WHEN row_number() OVER (PARTITION BY y3 ORDER BY {duck_h('vec_id')}, vec_id)
    <= round(count(*) OVER (PARTITION BY y3) * 0.2) THEN 'test' ELSE 'train' END AS split FROM {emb_sql()})"""


def _stratified(spark, sf):
    return S.stratified_split(emb(spark, sf), "vec_id", "y3", 0.2)


@query("l5_stratified_split", sql=f"SELECT vec_id, y3, split FROM {_STRAT_SQL}")
def l5_stratified_split(spark, sf):
    return _stratified(spark, sf).select("vec_id", "y3", "split")


@query("a12_split_summary", sql=f"""
SELECT split, count(*) AS rows, (SELECT max(len(embedding)) FROM embeddings) AS features FROM {_STRAT_SQL} GROUP BY split""")
def a12_split_summary(spark, sf):
    d = _stratified(spark, sf)
    return split_summary(d, "split", sum(c in EMB_COLS for c in d.columns))


@query("l6_chronological_split", sql=f"""
SELECT o_orderpriority, order_day, CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY order_day)
  <= floor(count(*) OVER (PARTITION BY o_orderpriority) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM {DAILY_SQL}""")
def l6_chronological_split(spark, sf):
    d = daily_orders(spark, sf).select("o_orderpriority", "order_day")
    return chronological_split(d, "o_orderpriority", "order_day", 0.8, bounded_series=True)


@query("l6_chronological_split_global", sql="""
SELECT o_orderkey, o_orderdate, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
  <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split FROM orders""")
def l6_chronological_split_global(spark, sf):
    from tidemill.operators.windows import chronological_split_global

    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return chronological_split_global(o, "o_orderdate", tie_cols=["o_orderkey"], train_frac=0.8)


@query("l7_oversample", sql=f"""
WITH m AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY {duck_u('c_custkey')}, c_custkey) - 1 AS pos
           FROM customer WHERE c_mktsegment = 'AUTOMOBILE'),
n AS (SELECT max(cnt) AS target FROM (SELECT count(*) AS cnt FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'
      GROUP BY c_mktsegment)),
d AS (SELECT CAST('0x' || substr(md5(CAST(i AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % (SELECT count(*) FROM m) AS pos
      FROM range((SELECT target FROM n)) t(i))
SELECT c_custkey, c_mktsegment, CAST(count(*) AS BIGINT) AS copies FROM (
  SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'
  UNION ALL SELECT m.c_custkey, m.c_mktsegment FROM d JOIN m USING (pos)) GROUP BY ALL""")
def l7_oversample(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    target = S.oversample_target(c, "c_mktsegment", "AUTOMOBILE", "max_class")
    out = S.oversample(c, "c_custkey", "c_mktsegment", "AUTOMOBILE", target)
    return out.groupBy("c_custkey", "c_mktsegment").agg(F.count(F.lit(1)).cast("bigint").alias("copies"))


@query("l8_balanced_weights", sql="""
SELECT c_custkey, c_mktsegment, round((SELECT count(*) FROM customer) /
  ((SELECT count(DISTINCT c_mktsegment) FROM customer) * count(*) OVER (PARTITION BY c_mktsegment)), 6) AS weight
FROM customer""")
def l8_balanced_weights(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return S.balanced_weights(c, "c_mktsegment").select("c_custkey", "c_mktsegment", r6("weight").alias("weight"))


@query("l9_inject_nulls", sql=f"""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT c_custkey FROM customer ORDER BY {duck_h('c_custkey')}, c_custkey
  LIMIT 15) THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer""")
def l9_inject_nulls(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return inject_nulls_n(c, "c_acctbal", "c_custkey", 15)


@query("u1_union_splits", sql="""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS split FROM orders""")
def u1_union_splits(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return union_splits({"finished": o.where(F.col("o_orderstatus") == "F"),
                         "open": o.where(F.col("o_orderstatus") != "F")})
