"""Gesture classification from multichannel signals (the EMG study's shape).

Each embedding row is a recording: a 1 x 64 signal (channel-major flat array). Sliding
windows (size 32, step 16) give MAV and RMS per channel per window (W7, array
expressions, row-parallel). Recordings, not windows, are split (quirk Q8: windows of one
recording never straddle train and test). Several classifiers are fitted once; macro F1
and accuracy per model come from one grouped aggregate; the choice prefers macro F1,
then accuracy (E13).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.exprs import round_half_up
from tidemill.operators import evaluate, models as M
from tidemill.operators.forest import fit_forest
from tidemill.operators.sampling import stratified_split
from tidemill.operators.signal import reshape_channels, window_features
from tidemill.plans.common import emb
from tidemill.sources.tables import read_table
from tidemill.session import cut_lineage


def window_table(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings").select("vec_id", "embedding")
    target = emb(spark, sf).select("vec_id", F.col("y3").alias("gesture"))
    rec = stratified_split(e.join(target, "vec_id"), "vec_id", "gesture", 0.2)   # split recordings first
    sig = rec.select("vec_id", "gesture", "split", reshape_channels(F.col("embedding"), 1).alias("signal"))
    w = window_features(sig, "signal", 32, 8, id_cols=["vec_id", "gesture", "split"])
    return w.withColumn("features", array_to_vector("features")).withColumn("label", F.col("gesture").cast("double"))


def model_scores(spark: SparkSession, sf: str) -> DataFrame:
    data = cut_lineage(window_table(spark, sf))
    tr = data.where(F.col("split") == "train")
    te = data.where(F.col("split") == "test")
    n = tr.count()
    ests = {"logistic": M.logistic(1.0, n), "decision_tree": M.decision_tree(), "naive_bayes": M.gaussian_nb()}
    outs = []
    for name, est in ests.items():
        p = est.fit(tr).transform(te)
        outs.append(p.select(F.lit(name).alias("model"), "vec_id", "window_index", "label", "prediction"))
    key, values = ["vec_id", "window_index"], vector_to_array("features")
    width = data.agg(F.max(F.size(values))).first()[0] or 0
    names = [f"f{i}" for i in range(width)]
    wide = data.withColumns({c: F.get(values, i) for i, c in enumerate(names)})
    p = fit_forest(wide.where(F.col("split") == "train"), names, "label", key, trees=100, max_depth=30).predict(wide.where(F.col("split") == "test"), key)
    outs.append(p.join(te.select(*key, "label"), key).select(F.lit("random_forest").alias("model"), *key, "label", "prediction"))
    preds = reduce(lambda a, b: a.unionByName(b), outs)
    return evaluate.multiclass_metrics_by(preds, "model")


def choose(spark: SparkSession, sf: str) -> DataFrame:
    """Best model by macro F1 (rounded to 8 digits), then accuracy, then name."""
    m = model_scores(spark, sf).withColumn("macro_f1_r", round_half_up(F.col("macro_f1"), 8))
    return evaluate.best_by(m, "model", "macro_f1_r", "accuracy").drop("macro_f1_r")
