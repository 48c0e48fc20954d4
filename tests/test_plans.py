"""Plan shape: scan pruning and pushdown, no single-partition windows on scale paths,
no Cartesian products anywhere among the registered queries."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
FIT_HEAVY = {"k1_kmeans_fit", "k8_compare_k", "k9_init_convergence", "k10_interpretation", "e14_model_suite",
             "e15_validation_choice", "m11_rbf_svc", "m12_rbf_svr", "m13_extra_trees", "a17_summary_report"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


#: fitted suites are planned by their own tests; the training-data queries have theirs
PLANNED = sorted(n for n in QUERIES if n not in FIT_HEAVY and not n.startswith(("flow_dirty", "flow_signal", "op", "pipeline")))


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_product(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    lines = p.splitlines()
    bad = [i for i, ln in enumerate(lines) if "CartesianProduct" in ln or "BroadcastNestedLoopJoin" in ln]
    assert not bad, "\n".join(x[:240] for x in lines[max(0, bad[0] - 2):bad[0] + 14])


def _scan_metadata(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    md = leaf.metadata()
    return {k: md.get(k).get() for k in ("PushedFilters", "ReadSchema")}


def test_filter_and_projection_reach_the_scan(spark):
    md = _scan_metadata(QUERIES["c12_filter"](spark, SF_SMALL))
    assert "EqualTo(l_returnflag,R)" in md["PushedFilters"]
    assert "GreaterThan(l_quantity,45.0)" in md["PushedFilters"]
    assert md["ReadSchema"] == "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>"


def _global_windows(text: str) -> list:
    """Window operators fed by ``Exchange SinglePartition`` (via their sort)."""
    lines = text.splitlines()
    out = []
    for i, ln in enumerate(lines):
        if "Window [" in ln and "WindowGroupLimit" not in ln:
            for nxt in lines[i + 1:i + 4]:
                if "Exchange" in nxt:
                    if "SinglePartition" in nxt:
                        out.append(ln)
                    break
    return out


@pytest.mark.parametrize("name", ["a16_cumsum_global", "c10_row_index", "e7_roc_auc", "e8_roc_curve", "m4_knn",
                                  "k3_silhouette_exact", "w1_lag", "w4_moving_average", "l6_chronological_split",
                                  "l5_stratified_split", "t3_first_seen_codes", "a14_box_stats",
                                  "l6_chronological_split_global", "w1_w5_event_series", "e5_confusion_matrix",
                                  "w1_w5_global_series"])
def test_scale_paths_have_no_single_partition_window_on_rows(spark, name):
    text = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().treeString()
    global_windows = _global_windows(text)
    # the only global windows allowed run over per-bucket totals (at most a few thousand rows), over the value carried
    # into each block (one row per block of a million rows) and over the list of classes (one row per class)
    for ln in global_windows:
        assert any(small in ln for small in ("_bkt", "_blk", "windowspecdefinition(cls#")), ln


def test_global_window_detector_sees_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    text = df._jdf.queryExecution().executedPlan().treeString()
    assert _global_windows(text)
