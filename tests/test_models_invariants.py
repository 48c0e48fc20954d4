"""Invariants for models without an exact counterpart (R rows)."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_MID
from tidemill.operators import models as M
from tidemill.operators.sampling import stratified_split
from tidemill.plans.common import emb

E8 = [f"e{i}" for i in range(1, 9)]


@pytest.fixture(scope="module")
def ring(spark):
    d = stratified_split(emb(spark, SF_MID, 8), "vec_id", "ring", 0.2)
    d = M.assembler(E8).transform(d).withColumn("label", F.col("ring").cast("double")).cache()
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test")


def _acc(p):
    return p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def _majority(te):
    return max(te.groupBy("label").count().collect(), key=lambda r: r["count"])["count"] / te.count()


@pytest.mark.parametrize("make", [
    lambda n: M.random_forest(num_trees=40, max_depth=8),
    lambda n: M.decision_tree(max_depth=8),
    lambda n: M.gradient_boosting(max_iter=30, depth=3),
])
def test_nonlinear_models_learn_ring(ring, make):
    tr, te = ring
    p = make(tr.count()).fit(tr).transform(te)
    assert _acc(p) > _majority(te) + 0.1
    if "probability" in p.columns:
        s = p.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b).alias("s"))
        assert s.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-9


def test_fourier_svm_beats_linear_on_ring(ring):
    tr, te = ring
    fm = M.FourierMap(d=8, n_components=256, gamma=M.gamma_scale(tr, E8), seed=42)
    p = M.rbf_svc(1.0, tr.count()).fit(fm.transform(tr)).transform(fm.transform(te))
    assert _acc(p) > _majority(te) + 0.1


def test_extra_trees_proxy_learns_ring(ring):
    tr, te = ring
    trv = tr.drop("features")
    models = M.extra_trees_proxy(trv, E8, "label", groups=2, trees_per_group=10, cuts=7)
    p = M.extra_trees_predict(models, te.drop("features"), ["vec_id", "label"])
    assert _acc(p) > _majority(te) + 0.1


def test_rows_only_queries_return_rows(spark):
    sql = E.oracle_sql()
    for name in ["m5_logistic", "t4_pca_two_components", "t6_pc1_importance", "m15_coefficient_table",
                 "flow_forecast_metrics"]:
        assert name not in sql
        assert E.queries()[name](spark, SF_MID).count() > 0


def test_flow_outputs_are_well_formed(spark):
    q = E.queries()
    suite = q["e14_model_suite"](spark, SF_MID).collect()
    candidates = [(m, g) for m in ("logistic", "random_forest", "gradient_boosting") for g in ("first_half", "second_half", "all")]
    candidates += [("rbf_svc", "all"), ("knn", "all"), ("random_forest", "mi_20"), ("random_forest", "pca_95")]
    assert {(r["model"], r["group"], r["split"]) for r in suite} == {(m, g, s) for m, g in candidates for s in ("train", "val", "test")}
    assert all(0 <= r[c] <= 1 for r in suite for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))
    auc = {(r["model"], r["group"]): r["roc_auc"] for r in suite if r["split"] == "train"}
    assert auc["random_forest", "all"] > 0.95 and auc["gradient_boosting", "all"] > 0.95
    report = q["e15_validation_choice"](spark, SF_MID).collect()
    assert [r["row"] for r in report][-3:] == ["accuracy", "macro avg", "weighted avg"]
    ks = q["k8_compare_k"](spark, SF_MID).collect()
    assert [r["k"] for r in sorted(ks)] == [2, 3, 4, 5, 6, 8]
    assert all(-1 <= r["silhouette"] <= 1 and r["inertia"] > 0 for r in ks)
    inertia = {r["k"]: r["inertia"] for r in ks}
    assert inertia[8] < inertia[2]
    conv = q["k9_init_convergence"](spark, SF_MID).collect()
    assert {r["init_mode"] for r in conv} == {"k-means++", "random"}
    imp = q["m14_feature_importance"](spark, SF_MID).collect()
    assert abs(sum(r["importance"] for r in imp) - 1) < 1e-9 or len(imp) == 10
    scores = q["m16_score_signal"](spark, SF_MID).agg(F.min("score"), F.max("score")).first()
    assert 0 <= scores[0] <= scores[1] <= 1


def test_forest_regressor_beats_the_mean(spark):
    p = E.queries()["m8_random_forest_regressor"](spark, SF_MID)
    r = p.agg(F.avg((F.col("label") - F.col("prediction")) ** 2).alias("mse"), F.var_pop("label").alias("var"), F.min("label").alias("lo"), F.max("label").alias("hi"),
              F.min("prediction").alias("plo"), F.max("prediction").alias("phi")).first()
    assert r["mse"] < 0.3 * r["var"]
    assert r["plo"] >= r["lo"] - 0.2 and r["phi"] <= r["hi"] + 0.2  # a forest averages labels it has seen


def test_kernel_regressor_learns_on_few_features(spark):
    d = M.assembler(E8[:3]).transform(emb(spark, SF_MID, 8)).withColumn("label", 3 * F.col("e1") - 2 * F.col("e2") + F.col("e3") * F.col("e3"))
    fm = M.FourierMap(d=3, n_components=128, gamma=M.gamma_scale(d, E8[:3]), seed=42)
    mapped = fm.transform(d).cache()
    p = M.rbf_svr(n=mapped.count()).fit(mapped).transform(mapped)
    r = p.agg(F.avg((F.col("label") - F.col("prediction")) ** 2).alias("mse"), F.var_pop("label").alias("var")).first()
    assert r["mse"] < 0.1 * r["var"]


def test_interpretation_reports_the_fitted_clusters(spark):
    (r,) = E.queries()["k10_interpretation"](spark, SF_MID).collect()
    assert r["k"] == 3 and r["matches_true_k"] == (r["true_k"] == r["k"])
    assert -1 <= r["silhouette"] <= 1 and r["davies_bouldin"] > 0 and r["calinski_harabasz"] > 0
