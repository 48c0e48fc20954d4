"""Registered queries: series windows (W1-W6, W9), signal windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import windows as W
from tidemill.operators.signal import reshape_channels, window_features
from tidemill.plans.catalog import query
from tidemill.plans.common import DAILY_SQL, daily_orders, r6, rk
from tidemill.sources.tables import read_table

_WIN = "PARTITION BY o_orderpriority ORDER BY order_day"


@query("w1_lag", sql=f"""
SELECT o_orderpriority, order_day, round(lag(total, 1) OVER ({_WIN}), 4) AS prev_total FROM {DAILY_SQL}""")
def w1_lag(spark, sf):
    w = W.series_window("o_orderpriority", "order_day")
    return daily_orders(spark, sf).select("o_orderpriority", "order_day",
                                          rk(W.lag_col("total", w), 4).alias("prev_total"))


@query("w2_lead", sql=f"""
SELECT o_orderpriority, order_day, round(lead(total, 1) OVER ({_WIN}), 4) AS next_total FROM {DAILY_SQL}""")
def w2_lead(spark, sf):
    w = W.series_window("o_orderpriority", "order_day")
    return daily_orders(spark, sf).select("o_orderpriority", "order_day",
                                          rk(W.lead_col("total", w), 4).alias("next_total"))


@query("w3_pct_change", sql=f"""
SELECT o_orderpriority, order_day, round(CASE WHEN p IS NULL THEN 0 WHEN p = 0 THEN NULL ELSE total / p - 1 END, 6)
  AS total_return FROM (SELECT *, lag(total) OVER ({_WIN}) AS p FROM {DAILY_SQL})""")
def w3_pct_change(spark, sf):
    w = W.series_window("o_orderpriority", "order_day")
    return daily_orders(spark, sf).select("o_orderpriority", "order_day",
                                          r6(W.pct_change_col("total", w)).alias("total_return"))


def _roll_sql(fn, k):
    frame = f"({_WIN} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(total) OVER {frame} = {k} THEN {fn}(total) OVER {frame} END"


@query("w4_moving_average", sql=f"""
SELECT o_orderpriority, order_day, round({_roll_sql('avg', 5)}, 4) AS ma_5, round({_roll_sql('avg', 10)}, 4) AS ma_10
FROM {DAILY_SQL}""")
def w4_moving_average(spark, sf):
    w = W.series_window("o_orderpriority", "order_day")
    return daily_orders(spark, sf).select("o_orderpriority", "order_day",
                                          rk(W.rolling_lag_col("total", w, 5), 4).alias("ma_5"),
                                          rk(W.rolling_lag_col("total", w, 10), 4).alias("ma_10"))


@query("w5_volatility", sql=f"""
SELECT o_orderpriority, order_day, round({_roll_sql('stddev_samp', 5)}, 4) AS volatility_5 FROM {DAILY_SQL}""")
def w5_volatility(spark, sf):
    w = W.series_window("o_orderpriority", "order_day")
    return daily_orders(spark, sf).select("o_orderpriority", "order_day",
                                          rk(W.rolling_lag_col("total", w, 5, "std"), 4).alias("volatility_5"))


@query("w6_top_k_per_group", sql="""
SELECT c_nationkey, c_custkey, c_acctbal FROM (
  SELECT c_nationkey, c_custkey, c_acctbal,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
WHERE rn <= 2""")
def w6_top_k_per_group(spark, sf):
    c = read_table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return W.top_k_per_group(c, "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 2)


def _signal_sql(channels: int, t: int, size: int, step: int, bypass: bool) -> str:
    """DuckDB twin of W7 for a fixed signal shape."""
    if bypass:
        return f"""SELECT vec_id, CAST(0 AS INTEGER) AS window_index,
  list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6)) AS features FROM embeddings"""
    n_win = (t - size) // step + 1
    rows = []
    for wi in range(n_win):
        s = wi * step
        mavs = [f"round(list_avg(list_transform(embedding[{c * t + s + 1}:{c * t + s + size}], "
                f"lambda x: abs(CAST(x AS DOUBLE)))), 6)" for c in range(channels)]
        rmss = [f"round(sqrt(list_avg(list_transform(embedding[{c * t + s + 1}:{c * t + s + size}], "
                f"lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6)" for c in range(channels)]
        rows.append(f"SELECT vec_id, CAST({wi} AS INTEGER) AS window_index, "
                    f"[{', '.join(mavs + rmss)}] AS features FROM embeddings")
    return " UNION ALL ".join(rows)


@query("w7_signal_windows", sql=_signal_sql(1, 64, 32, 16, False))
def w7_signal_windows(spark, sf):
    e = read_table(spark, sf, "embeddings")
    sig = e.select("vec_id", reshape_channels(F.col("embedding"), 1).alias("signal"))
    out = window_features(sig, "signal", 32, 8, id_cols=["vec_id"])
    return out.select("vec_id", "window_index", F.transform("features", lambda v: rk(v, 6)).alias("features"))


@query("w7_short_signal_bypass", sql=_signal_sql(8, 8, 8, 4, True))
def w7_short_signal_bypass(spark, sf):
    e = read_table(spark, sf, "embeddings")
    sig = e.select("vec_id", reshape_channels(F.col("embedding"), 8).alias("signal"))
    out = window_features(sig, "signal", 32, 8, id_cols=["vec_id"])
    return out.select("vec_id", "window_index", F.transform("features", lambda v: rk(v, 6)).alias("features"))


@query("w7_event_windows", sql="""
SELECT user_id, window_start, CAST(count(*) AS BIGINT) AS n,
  round(avg(abs(value)), 6) AS mav, round(sqrt(avg(value * value)), 6) AS rms
FROM (SELECT user_id, value, ts, time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR * k AS window_start
      FROM events, (VALUES (0), (1)) AS s(k))
WHERE ts >= window_start AND ts < window_start + INTERVAL 1 DAY
GROUP BY user_id, window_start""")
def w7_event_windows(spark, sf):
    """W7 long form: per user, sliding 1-day windows every 12 hours over ``events``;
    mean absolute value and root mean square per window (grouped aggregate with
    partial aggregation; hot users are split by window)."""
    ev = read_table(spark, sf, "events")
    from tidemill.streaming.signal_windows import windowed_mav_rms

    return windowed_mav_rms(ev, "user_id", "ts", "value", "1 day", "12 hours")


@query("w8_reshape", sql="""
SELECT vec_id, [list_transform(embedding[c * 8 + 1:c * 8 + 8], lambda x: CAST(x AS DOUBLE)) FOR c IN range(8)] AS signal
FROM embeddings""")
def w8_reshape(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", reshape_channels(F.col("embedding"), 8).alias("signal"))


@query("w9_first_per_class", sql="""
SELECT r.r_regionkey AS n_regionkey, n.n_nationkey, n.n_name FROM region r LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn
                 FROM nation WHERE n_regionkey <> 3) WHERE rn = 1) n ON r.r_regionkey = n.n_regionkey""")
def w9_first_per_class(spark, sf):
    n = read_table(spark, sf, "nation").where(F.col("n_regionkey") != 3)
    classes = read_table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    return W.first_per_class(n, "n_regionkey", "n_nationkey", classes).select("n_regionkey", "n_nationkey", "n_name")


_EV = "PARTITION BY user_id ORDER BY ts, event_id"


def _ev_roll(fn, k):
    frame = f"({_EV} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(value) OVER {frame} = {k} THEN {fn}(value) OVER {frame} END"


@query("w1_w5_event_series", sql=f"""
SELECT event_id, user_id, lag(value) OVER ({_EV}) AS prev_value, lead(value) OVER ({_EV}) AS next_value,
  round(CASE WHEN lag(value) OVER ({_EV}) IS NULL THEN 0 WHEN lag(value) OVER ({_EV}) = 0 THEN NULL
        ELSE value / lag(value) OVER ({_EV}) - 1 END, 6) AS value_return,
  round({_ev_roll('avg', 5)}, 6) AS ma_5, round({_ev_roll('avg', 10)}, 6) AS ma_10,
  round({_ev_roll('stddev_samp', 5)}, 6) AS volatility_5
FROM events""")
def w1_w5_event_series(spark, sf):
    """W1-W5 on raw rows of a possibly hot series (one user may hold a large share of
    the events): halo-blocked windows, parallel inside every series."""
    from tidemill.operators.blocked_series import blocked_series_features

    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    f = blocked_series_features(ev, ["user_id"], "ts", "value", tie_cols=["event_id"])
    return f.select("event_id", "user_id", "prev_value", "next_value", r6("value_return").alias("value_return"),
                    *[r6(c).alias(c) for c in ("ma_5", "ma_10", "volatility_5")])


_GL = "ORDER BY o_orderdate, o_orderkey"


def _gl_roll(fn, k):
    frame = f"({_GL} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(o_totalprice) OVER {frame} = {k} THEN {fn}(o_totalprice) OVER {frame} END"


@query("w1_w5_global_series", sql=f"""
SELECT o_orderkey, lag(o_totalprice) OVER ({_GL}) AS prev_o_totalprice,
  lead(o_totalprice) OVER ({_GL}) AS next_o_totalprice,
  round(CASE WHEN lag(o_totalprice) OVER ({_GL}) IS NULL THEN 0 WHEN lag(o_totalprice) OVER ({_GL}) = 0 THEN NULL
        ELSE o_totalprice / lag(o_totalprice) OVER ({_GL}) - 1 END, 6) AS o_totalprice_return,
  round({_gl_roll('avg', 5)}, 6) AS ma_5, round({_gl_roll('avg', 10)}, 6) AS ma_10,
  round({_gl_roll('stddev_samp', 5)}, 6) AS volatility_5
FROM orders""")
def w1_w5_global_series(spark, sf):
    """W1-W5 over one table-wide series (all orders in date order): no series key, yet
    no single-partition window (halo blocks over exact global positions)."""
    from tidemill.operators.blocked_series import blocked_series_features

    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    f = blocked_series_features(o, [], "o_orderdate", "o_totalprice", tie_cols=["o_orderkey"])
    return f.select("o_orderkey", "prev_o_totalprice", "next_o_totalprice",
                    r6("o_totalprice_return").alias("o_totalprice_return"),
                    *[r6(c).alias(c) for c in ("ma_5", "ma_10", "volatility_5")])
