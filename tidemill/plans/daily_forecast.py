"""Flagship: next-day order total per priority (the time-series regression study).

orders -> daily totals per priority (partial + final aggregate; the result is bounded
by days x priorities) -> calendar parts, lag, lead target, percent change, moving
averages and volatility of the lagged total (one exchange + sort for all windows)
-> drop incomplete rows -> first 80 % of each priority's days train -> least
squares on train -> MAE / MSE / RMSE / R2 / adjusted R2 on the test days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.exprs import date_parts
from tidemill.operators.evaluate import metrics_long, regression_metrics
from tidemill.operators.models import assembler, least_squares
from tidemill.operators.windows import add_series_features, chronological_split
from tidemill.sources.tables import read_table
from tidemill.session import cut_lineage

SERIES = "o_orderpriority"
FEATURES = ["prev_total", "ma_5", "ma_10", "volatility_5", "total_return", "day_of_week", "month"]


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return orders.groupBy(SERIES, F.to_date("o_orderdate").alias("order_day")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n_orders"))


def daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_totals(spark, sf_dir)
    parts = date_parts(F.col("order_day"))
    with_dates = daily.select("*", *[c.alias(n) for n, c in parts.items()])
    feats = add_series_features(with_dates, SERIES, "order_day", "total")
    return feats


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = daily_features(spark, sf_dir).na.drop("any")
    return chronological_split(feats, SERIES, "order_day", 0.8, bounded_series=True)  # days x priorities


def forecast_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = model_table(spark, sf_dir)
    va = assembler(FEATURES)
    data = cut_lineage(va.transform(table).select(SERIES, "order_day", "split", "features", F.col("next_total").alias("label")))
    model = least_squares().fit(data.where(F.col("split") == "train"))
    return model.transform(data.where(F.col("split") == "test"))


def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = forecast_predictions(spark, sf_dir)
    wide = regression_metrics(pred, "label", "prediction", n_features=len(FEATURES))
    return metrics_long(wide)
