"""Classification on a dirty table (the telecom-churn study's shape, SURVEY §3.1).

customer rows with junk numeric text and duplicates -> coercing cast (C2) -> median
imputation (C4) -> duplicate removal (C8) -> label encoding of the nation (T2) ->
binary target from text (C14) -> stratified split (L5) -> standardisation fitted on
train only (T1) -> logistic regression, random forest, gradient boosting (M5, M7, M9)
-> accuracy / precision / recall / F1 / ROC-AUC per model in one grouped aggregate
(E1, E2, E7, E12) -> best model (A15).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.exprs import yes_flag
from tidemill.operators import clean, encode, evaluate, models as M
from tidemill.operators.forest import fit_forest
from tidemill.operators.sampling import stratified_split
from tidemill.plans.common import dirty_customer
from tidemill.session import cut_lineage

FEATURES = ["acct_cents", "c_nationkey_code", "acct_was_dirty"]


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    d = dirty_customer(spark, sf)
    d = d.unionByName(d.where(F.col("c_custkey") % 50 == 0))          # duplicated rows
    d = clean.coerce_numeric(d.withColumn("acct_cents", F.col("acct_text")), ["acct_cents"])
    d = d.withColumn("acct_was_dirty", F.col("acct_cents").isNull().cast("double"))  # data-quality feature
    d = clean.drop_duplicate_rows(d)
    d = clean.impute_median(d, ["acct_cents"])
    d = encode.label_encode(d.withColumn("c_nationkey", F.col("c_nationkey").cast("string")), "c_nationkey")
    return d.withColumn("label", yes_flag("c_mktsegment", "BUILDING").cast("double"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    d = cut_lineage(stratified_split(cleaned(spark, sf), "c_custkey", "label", 0.2))
    train = d.where(F.col("split") == "train")
    stats = encode.fit_standardizer(train, FEATURES)
    z = encode.apply_standardizer(d, stats)
    data = M.assembler(FEATURES).transform(z)
    tr = data.where(F.col("split") == "train")
    n = tr.count()
    ests = {"logistic": M.logistic(1.0, n), "gradient_boosting": M.gradient_boosting(max_iter=100, depth=3)}
    outs = []
    for name, est in ests.items():
        p = est.fit(tr).transform(data.where(F.col("split") == "test"))
        outs.append(p.select(F.lit(name).alias("model"), "c_custkey", "label", "prediction",
                             vector_to_array("probability")[1].alias("score")))
    te = data.where(F.col("split") == "test")
    forest = fit_forest(tr, FEATURES, "label", ["c_custkey"], trees=100, max_depth=30)
    p = forest.predict(te, ["c_custkey"]).join(te.select("c_custkey", "label"), "c_custkey")
    outs.append(p.select(F.lit("random_forest").alias("model"), "c_custkey", "label", "prediction", forest.share_of(1.0).alias("score")))
    return reduce(lambda a, b: a.unionByName(b), outs)


def comparison(spark: SparkSession, sf: str) -> DataFrame:
    p = cut_lineage(predictions(spark, sf))
    m = evaluate.binary_metrics_by(p, "model")
    return m.join(evaluate.roc_auc_by(p, "model"), "model").orderBy(F.col("f1").desc(), F.col("accuracy").desc(), "model")
