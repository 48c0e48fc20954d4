"""Distributed exact algorithms agree with single-machine references."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF_MID
from tidemill.operators.cluster import assign, seed_centroids, silhouette_exact
from tidemill.operators.evaluate import roc_auc
from tidemill.operators.knn import knn_classify
from tidemill.operators.ordered import running_totals
from tidemill.operators.quantiles import quantiles
from tidemill.plans.common import emb
from tidemill.sources.tables import read_table

E8 = [f"e{i}" for i in range(1, 9)]


def test_selection_path_equals_numpy(spark):
    li = read_table(spark, SF_MID, "lineitem").withColumn(
        "dup", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7.0)).otherwise(F.col("l_discount")))
    cols = ["l_extendedprice", "l_quantity", "dup"]
    pdf = li.select(*cols).toPandas()
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    for task_rows, buckets in ((2000, 16), (50, 4)):
        q = quantiles(li, cols, probs, task_rows=task_rows, buckets=buckets)
        for c in cols:
            assert np.allclose(q[c], np.quantile(pdf[c], probs), rtol=0, atol=1e-9), (c, task_rows)


def test_grouped_selection_equals_pandas(spark):
    from tidemill.operators.quantiles import grouped_quantiles

    li = read_table(spark, SF_MID, "lineitem")
    long = li.select(F.col("l_returnflag").alias("feature"), F.col("l_extendedprice").alias("v"))
    got = grouped_quantiles(long, [0.25, 0.5, 0.75], task_rows=500, buckets=8)
    p = li.select("l_returnflag", "l_extendedprice").toPandas()
    for f, g in p.groupby("l_returnflag"):
        assert np.allclose(got[f], np.quantile(g["l_extendedprice"], [0.25, 0.5, 0.75]), rtol=0, atol=1e-9)


def test_rank_within_equals_window(spark):
    from tidemill.functions.hashing import hash_hex
    from tidemill.operators.sampling import rank_within
    from pyspark.sql import Window

    o = read_table(spark, SF_MID, "orders").select("o_orderkey", "o_orderpriority")
    got = rank_within(o, "o_orderpriority", "o_orderkey", buckets=16).select("o_orderkey", "_rank")
    w = Window.partitionBy("o_orderpriority").orderBy(hash_hex("o_orderkey"), "o_orderkey")
    exp = o.select("o_orderkey", F.row_number().over(w).alias("_rank"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_grouped_running_totals_with_a_hot_group(spark):
    o = read_table(spark, SF_MID, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    o = o.withColumn("g", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey") % 7))
    got = running_totals(o.withColumn("one", F.lit(1)), "o_totalprice", ["one"], tie_cols=["o_orderkey"],
                         group_cols=["g"], target_rows=700).toPandas()
    p = o.toPandas().sort_values(["g", "o_totalprice", "o_orderkey"])
    p["exp"] = p.groupby("g").cumcount() + 1
    m = got.merge(p[["o_orderkey", "exp"]], on="o_orderkey")
    assert len(m) == len(p) and (m["one_cum"] == m["exp"]).all()


def test_running_totals_equal_cumsum(spark):
    o = read_table(spark, SF_MID, "orders").select("o_orderkey", "o_totalprice", F.lit(1).alias("one"))
    r = running_totals(o, "o_totalprice", ["one", "o_totalprice"], tie_cols=["o_orderkey"],
                       target_rows=1000).toPandas()
    p = o.toPandas().sort_values(["o_totalprice", "o_orderkey"])
    p["exp"] = p["one"].cumsum()
    m = r.merge(p[["o_orderkey", "exp"]], on="o_orderkey")
    assert (m["one_cum"] == m["exp"]).all()
    rd = running_totals(o, "o_totalprice", ["one"], tie_cols=["o_orderkey"], descending=True,
                        target_rows=1000).toPandas()
    p2 = o.toPandas().sort_values(["o_totalprice", "o_orderkey"], ascending=False)
    p2["exp"] = p2["one"].cumsum()
    m2 = rd.merge(p2[["o_orderkey", "exp"]], on="o_orderkey")
    assert (m2["one_cum"] == m2["exp"]).all()


def test_knn_blocked_equals_brute_force(spark):
    from tidemill.operators.sampling import random_split

    d = random_split(emb(spark, SF_MID, 8), "vec_id", 0.2)
    tr = d.where(F.col("split") == "train")
    te = d.where(F.col("split") == "test")
    # several blocks on both sides exercise the block pairing
    got = knn_classify(tr, te, E8, "y3", "vec_id", "vec_id", k=5, block_rows=64).toPandas()
    ptr, pte = tr.toPandas(), te.toPandas()
    X, Q = ptr[E8].to_numpy(), pte[E8].to_numpy()
    dist = np.sqrt(((Q[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    exp = {}
    for i, qid in enumerate(pte["vec_id"]):
        order = np.lexsort((ptr["vec_id"].to_numpy(), dist[i]))[:5]
        votes = pd.Series(ptr["y3"].to_numpy()[order]).value_counts()
        exp[qid] = float(min(votes[votes == votes.max()].index))
    assert {r.vec_id: r.prediction for r in got.itertuples()} == exp


def test_exact_silhouette_equals_numpy(spark):
    d = emb(spark, SF_MID, 8)
    a = assign(d, E8, seed_centroids(d, "vec_id", E8, 3))
    got = silhouette_exact(a, "vec_id", E8, "cluster", block_rows=100).first()[0]
    p = a.toPandas()
    X, lab = p[E8].to_numpy(), p["cluster"].to_numpy()
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        ai = D[i, own].sum() / (own.sum() - 1)
        bi = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((bi - ai) / max(ai, bi))
    assert abs(got - np.mean(s)) < 1e-9


def test_roc_auc_equals_rank_formula(spark):
    from tidemill.plans.common import scored_docs

    s = scored_docs(spark, SF_MID)
    got = roc_auc(s, target_rows=50).first()[0]
    p = s.toPandas()
    ranks = p["score"].rank()
    pos = p["label"] == 1
    n1, n0 = pos.sum(), (~pos).sum()
    assert abs(got - (ranks[pos].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)) < 1e-12


def test_blocked_series_windows_equal_plain_windows(spark):
    from pyspark.sql import Window

    from tidemill.operators.blocked_series import blocked_series_features
    from tidemill.operators.windows import add_series_features

    ev = read_table(spark, SF_MID, "events").select("event_id", "user_id", "ts", "value")
    # one artificial hot series: a third of the rows moved to user 0
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    got = blocked_series_features(ev, ["user_id"], "ts", "value", tie_cols=["event_id"], block_rows=37)
    w_cols = ["event_id", "prev_value", "next_value", "value_return", "ma_5", "ma_10", "volatility_5"]
    exp = add_series_features(ev, ["user_id"], ["ts", "event_id"], "value")
    a = {r["event_id"]: tuple(r[c] for c in w_cols) for r in got.select(*w_cols).collect()}
    b = {r["event_id"]: tuple(r[c] for c in w_cols) for r in exp.select(*w_cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None and y is None) or abs(x - y) < 1e-9, (k, a[k], b[k])


def test_wide_vector_distances_match_exact_differences():
    from tidemill.operators.knn import squared_distances

    rng = np.random.default_rng(3)
    q, t = rng.normal(size=(7, 784)), rng.normal(size=(50, 784))
    exact = ((q[:, None, :] - t[None, :, :]) ** 2).sum(-1)
    assert np.allclose(squared_distances(q, t), exact, rtol=1e-10, atol=1e-9)


def test_knn_on_all_64_dimensions(spark):
    from tidemill.operators.sampling import random_split

    e = read_table(spark, SF_MID, "embeddings")
    cols = [f"d{i}" for i in range(64)]
    d = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    d = random_split(d, "vec_id", 0.2)
    tr, te = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    got = knn_classify(tr, te, cols, "label", "vec_id", "vec_id", k=3, block_rows=100).toPandas()
    ptr, pte = tr.toPandas(), te.toPandas()
    X, Q = ptr[cols].to_numpy(), pte[cols].to_numpy()
    dist = ((Q[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    for i, qid in enumerate(pte["vec_id"]):
        order = np.lexsort((ptr["vec_id"].to_numpy(), dist[i]))[:3]
        votes = pd.Series(ptr["label"].to_numpy()[order]).value_counts()
        exp = float(min(votes[votes == votes.max()].index))
        assert got.loc[got.vec_id == qid, "prediction"].iloc[0] == exp


def test_blocked_global_series_equals_window(spark):
    from pyspark.sql import Window

    from tidemill.operators.blocked_series import blocked_series_features
    from tidemill.operators.windows import with_series_features

    o = read_table(spark, SF_MID, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    got = blocked_series_features(o, [], "o_orderdate", "o_totalprice", tie_cols=["o_orderkey"], block_rows=500)
    exp = with_series_features(o, Window.orderBy("o_orderdate", "o_orderkey"), "o_totalprice")
    cols = ["o_orderkey", "prev_o_totalprice", "next_o_totalprice", "o_totalprice_return", "ma_5", "volatility_5"]
    a = {r[0]: r for r in got.select(*cols).collect()}
    b = {r[0]: r for r in exp.select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None and y is None) or abs(x - y) < 1e-6, (k, a[k], b[k])
    text = got._jdf.queryExecution().executedPlan().treeString()
    assert "CartesianProduct" not in text


def test_large_n_sample_paths_equal_top_n(spark):
    from tidemill.functions.hashing import hash_hex
    from tidemill.operators import clean, sampling

    c = read_table(spark, SF_MID, "customer").select("c_custkey", "c_acctbal")
    exp = {r[0] for r in c.orderBy(hash_hex("c_custkey"), "c_custkey").limit(300).collect()}
    old = sampling.TOP_N_MAX, clean.BROADCAST_KEYS_MAX
    try:
        sampling.TOP_N_MAX, clean.BROADCAST_KEYS_MAX = 10, 10
        got = {r[0] for r in sampling.sample_n(c, "c_custkey", 300).collect()}
        nulls = {r[0] for r in clean.inject_nulls_n(c, "c_acctbal", "c_custkey", 300).where("c_acctbal IS NULL").collect()}
    finally:
        sampling.TOP_N_MAX, clean.BROADCAST_KEYS_MAX = old
    assert got == exp and nulls == exp


def test_blocked_fill_and_chronological_split_equal_plain_windows(spark):
    from pyspark.sql import Window

    from tidemill.operators.blocked_series import blocked_fill
    from tidemill.operators.windows import chronological_split, ffill_bfill_col

    ev = read_table(spark, SF_MID, "events").select("event_id", "user_id", "ts", "value")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    # long null runs: most values of the hot user missing
    ev = ev.withColumn("value", F.when((F.col("user_id") == 0) & (F.col("event_id") % 97 != 0), F.lit(None))
                       .otherwise(F.col("value")))
    got = blocked_fill(ev, ["user_id"], "ts", "value", tie_cols=["event_id"], block_rows=40)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    exp = ev.withColumn("value_filled", ffill_bfill_col("value", w))
    a = {r[0]: r[1] for r in got.select("event_id", "value_filled").collect()}
    b = {r[0]: r[1] for r in exp.select("event_id", "value_filled").collect()}
    assert a == b
    split = chronological_split(ev, "user_id", ["ts", "event_id"], 0.8, block_rows=40)
    n = ev.groupBy("user_id").count()
    rn = ev.withColumn("_r", F.row_number().over(w)).join(n, "user_id")
    exp_split = rn.withColumn("split", F.when(F.col("_r") <= F.floor(F.col("count") * 0.8), "train").otherwise("test"))
    assert sorted(map(tuple, split.select("event_id", "split").collect())) == \
        sorted(map(tuple, exp_split.select("event_id", "split").collect()))


def test_approximate_quantiles_are_close(spark):
    li = read_table(spark, SF_MID, "lineitem")
    probs = [0.1, 0.5, 0.9]
    approx = quantiles(li, ["l_extendedprice"], probs, approx=True)["l_extendedprice"]
    exact = np.quantile(li.select("l_extendedprice").toPandas()["l_extendedprice"], probs)
    assert np.allclose(approx, exact, rtol=2e-3)


def test_small_targets_do_not_make_a_task_per_few_rows(spark):
    from tidemill.operators import ordered

    d = spark.range(6_000).withColumn("v", F.lit(1))
    rp, parts = ordered.range_partitioned(d, [F.col("id").asc()], 2)
    assert parts <= ordered.SMALL_PARTS
    got = ordered.running_totals(d, "id", ["v"], target_rows=2)
    assert got.where("v_cum <> id + 1").count() == 0 and got.count() == 6_000
    assert ordered.range_partitioned(d, [F.col("id").asc()], 1_000)[1] == 6


def test_cuts_below_a_value_are_found_without_a_look_at_each(spark):
    from tidemill.operators.quantiles import cuts_below

    for n in (1, 2, 3, 7, 8, 1023):
        cuts = [float(3 * i) for i in range(n)]
        d = spark.createDataFrame([(float(x),) for x in range(-2, 3 * n + 2)], "v double")
        got = d.select("v", cuts_below(F.array(*[F.lit(c) for c in cuts]), F.col("v"), n).alias("p")).collect()
        assert [r["p"] for r in got] == [sum(c < r["v"] for c in cuts) for r in got]


def test_distance_sums_equal_differences_for_equal_close_and_far_rows():
    from tidemill.operators.cluster import TILE, distance_sums
    from tidemill.operators.knn import squared_distances

    rng = np.random.default_rng(8)
    q = rng.normal(size=(TILE[0] + 20, 5)) + 100.0
    t = np.concatenate([q, q + 1e-9, rng.normal(size=(TILE[1], 5))])
    members = np.eye(3)[rng.integers(0, 3, len(t))]
    want = np.sqrt(squared_distances(q, t)) @ members
    assert np.allclose(distance_sums(q, t, members), want, rtol=1e-11, atol=0)
    assert distance_sums(q[:1], q[:1], np.ones((1, 1)))[0, 0] == 0.0
    t[3, 0], q[5, 1] = np.nan, np.inf
    with np.errstate(invalid="ignore"):
        assert np.allclose(distance_sums(q, t, members), np.sqrt(squared_distances(q, t)) @ members, equal_nan=True)


def test_exact_silhouette_is_the_same_for_any_blocks_and_sends_few_rows(spark, monkeypatch):
    from tidemill.operators import cluster as K

    e = emb(spark, SF_MID, 8)
    a = assign(e, E8, seed_centroids(e, "vec_id", E8, 3))
    monkeypatch.setattr(K, "WIDE", 3)
    got = [silhouette_exact(a, "vec_id", E8, "cluster", block_rows=b).first()[0] for b in (5, 40, 4096)]
    assert np.allclose(got, got[0], rtol=0, atol=1e-12)
    sent = []
    plain = pa.RecordBatch.from_pydict
    batch = plain({"q_blk": [0], "q_ids": [[1, 2]], "q_vecs": [[[0.0], [3.0]]], "t_vecs": [[[0.0], [4.0]]], "t_labels": [[0.0, 1.0]]})
    for part in K._cluster_sums(iter([batch] * 50)):
        sent += part.to_pylist()
    assert sorted((r["qid"], r["cl"], r["sum_d"], r["cnt"]) for r in sent) == [(1, 0.0, 0.0, 50), (1, 1.0, 200.0, 50), (2, 0.0, 150.0, 50), (2, 1.0, 50.0, 50)]
