"""Shared derived inputs for the registered queries, each with its DuckDB twin.

The driver tables carry no nulls, duplicates or dirty text, and ``embeddings.label``
is unrelated to the vectors; defects and learnable targets are therefore derived by
deterministic expressions that Spark and DuckDB evaluate identically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.exprs import round_half_up
from tidemill.functions.hashing import hash_uniform
from tidemill.sources.tables import read_table


def rk(c, digits: int) -> Column:
    """Engine-independent rounding (see ``round_half_up``); the twin SQL's
    ``round(x, d)`` is evaluated with the same formula (``catalog.half_up_sql``)."""
    return round_half_up(c, digits)


def r6(c) -> Column:
    return rk(c, 6)


def duck_u(key_sql: str, seed: int = 42) -> str:
    """DuckDB twin of ``hash_uniform``."""
    return (f"(CAST('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"
            f" / 4294967296.0)")


def duck_h(key_sql: str, seed: int = 42) -> str:
    return f"md5(CAST({key_sql} AS VARCHAR) || '|{seed}')"


# ---- dirty customer text: acct balance in cents as text, with junk ---------------------

def dirty_customer(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    k = F.col("c_custkey") % 10
    text = (F.when(k == 3, F.concat(cents, F.lit("_"))).when(k == 7, F.lit("_"))
            .when(k == 5, F.lit("")).otherwise(cents))
    return c.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", text.alias("acct_text"))


DIRTY_CUSTOMER_SQL = """(SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal,
  CASE WHEN c_custkey % 10 = 3 THEN CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) || '_'
       WHEN c_custkey % 10 = 7 THEN '_'
       WHEN c_custkey % 10 = 5 THEN ''
       ELSE CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) END AS acct_text
  FROM customer)"""


def customer_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """10 % of balances and (another) 10 % of segments set to null by seeded hash."""
    c = read_table(spark, sf, "customer")
    return c.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(hash_uniform("c_custkey", 42) < 0.1, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(hash_uniform("c_custkey", 7) < 0.1, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )


CUSTOMER_NULLS_SQL = f"""(SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN {duck_u('c_custkey', 42)} < 0.1 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN {duck_u('c_custkey', 7)} < 0.1 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""


# ---- embeddings: all dimensions as doubles, and the derived targets ---------------------

EMB_DIMS = 64
EMB_COLS = [f"e{i}" for i in range(1, EMB_DIMS + 1)]


def emb(spark: SparkSession, sf: str, dims: int = EMB_DIMS) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    cols = [F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(dims)]
    out = e.select("vec_id", "label", *cols)
    a = [F.col(f"e{i}") for i in (1, 2, 3)]
    y3 = F.when((a[0] >= a[1]) & (a[0] >= a[2]), 0).when(a[1] >= a[2], 1).otherwise(2)
    ring = ((F.col("e1") * F.col("e1") + F.col("e2") * F.col("e2")) > 0.02).cast("int")
    return out.select("*", y3.alias("y3"), ring.alias("ring"))


def emb_sql(dims: int = EMB_DIMS) -> str:
    cols = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i + 1}" for i in range(dims))
    return f"""(SELECT *,
  CASE WHEN e1 >= e2 AND e1 >= e3 THEN 0 WHEN e2 >= e3 THEN 1 ELSE 2 END AS y3,
  CAST(e1 * e1 + e2 * e2 > 0.02 AS INTEGER) AS ring
  FROM (SELECT vec_id, label, {cols} FROM embeddings))"""


# ---- daily order totals per priority ----------------------------------------------------

def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("order_day")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n_orders"))


DAILY_SQL = """(SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS order_day,
  sum(o_totalprice) AS total, count(*) AS n_orders
  FROM orders GROUP BY 1, 2)"""


# ---- binary predictions by a fixed rule (labels joined with documents) ------------------

def scored_docs(spark: SparkSession, sf: str) -> DataFrame:
    """label = toxic; score = a fixed function of the text length; prediction = score > 0.5."""
    lab = read_table(spark, sf, "labels")
    doc = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    score = rk((F.col("n_chars") % 997) / 996.0, 3)
    return j.select("doc_id", F.col("toxic").alias("label"), score.alias("score"),
                    (score > 0.5).cast("int").alias("prediction"))


SCORED_SQL = """(SELECT doc_id, toxic AS label, round((n_chars % 997) / 996.0, 3) AS score,
  CAST(round((n_chars % 997) / 996.0, 3) > 0.5 AS INTEGER) AS prediction
  FROM labels JOIN documents USING (doc_id))"""


# ---- multi-class predictions by a fixed rule on the embeddings --------------------------

def multiclass_preds(spark: SparkSession, sf: str) -> DataFrame:
    """label = y3 (derived target); prediction = the same rule on noisier inputs."""
    e = emb(spark, sf)
    a = [F.col("e1") + F.col("e4") * 0.5, F.col("e2") + F.col("e5") * 0.5, F.col("e3") + F.col("e6") * 0.5]
    pred = F.when((a[0] >= a[1]) & (a[0] >= a[2]), 0).when(a[1] >= a[2], 1).otherwise(2)
    return e.select("vec_id", F.col("y3").alias("label"), pred.alias("prediction"))


MULTI_SQL = f"""(SELECT vec_id, y3 AS label,
  CASE WHEN e1 + e4 * 0.5 >= e2 + e5 * 0.5 AND e1 + e4 * 0.5 >= e3 + e6 * 0.5 THEN 0
       WHEN e2 + e5 * 0.5 >= e3 + e6 * 0.5 THEN 1 ELSE 2 END AS prediction
  FROM {emb_sql()})"""
