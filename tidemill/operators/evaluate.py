"""Evaluation and model comparison.

Every metric is an aggregate over a ``(label, prediction[, score])`` table computed
on executors; predictions are never collected. Per-class metrics come from one
``groupBy(label, prediction).count()`` whose size is classes^2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exprs import round_half_up
from tidemill.operators.joins import null_safe_join
from tidemill.operators.ordered import TARGET_ROWS, running_totals


def _div0(a: Column, b: Column) -> Column:
    """``zero_division=0``."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """E1."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def binary_prf(df: DataFrame, label: str = "label", pred: str = "prediction", positive=1) -> DataFrame:
    """Precision / recall / F1 of the positive class (zero division -> 0)."""
    y = F.col(label) == F.lit(positive)
    p = F.col(pred) == F.lit(positive)
    agg = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"))
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    return agg.select(prec.alias("precision"), rec.alias("recall"),
                      _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def class_table(df: DataFrame, label: str, pred: str, classes: list | None = None) -> DataFrame:
    """``cls, i``: the classes of a table (labels and predictions; a null is a class of its own, last), or the
    given ones, with their 0-based place. One row per class."""
    if classes is not None:
        kind = df.schema[label].dataType.simpleString()
        return df.sparkSession.createDataFrame([(i, None if c is None else str(c)) for i, c in enumerate(classes)], "i bigint, c string").select(
            F.col("c").cast(kind).alias("cls"), "i")
    vals = df.select(F.col(label).alias("cls")).union(df.select(F.col(pred).alias("cls"))).distinct()
    return vals.select("cls", (F.row_number().over(Window.orderBy(F.col("cls").asc_nulls_last())) - 1).cast("bigint").alias("i"))


def confusion_long(df: DataFrame, label: str = "label", pred: str = "prediction",
                   classes: list | None = None) -> DataFrame:
    """E5: ``(label, prediction, count)`` for every class pair, zeros kept; a null label or prediction counts
    under the class null. The k^2 cells are generated by a distributed ``range`` and meet the classes and
    the observed counts in equi-joins; no class list reaches the driver."""
    table = class_table(df, label, pred, classes)
    k = table.count()
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))
    cells = df.sparkSession.range(k * k).select(F.floor(F.col("id") / max(k, 1)).alias("_i"), (F.col("id") % max(k, 1)).alias("_j"))
    cells = (cells.join(table.select(F.col("cls").alias("label"), F.col("i").alias("_i")), "_i")
             .join(table.select(F.col("cls").alias("prediction"), F.col("i").alias("_j")), "_j").drop("_i", "_j"))
    return (null_safe_join(cells, counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def confusion_wide(df: DataFrame, label: str = "label", pred: str = "prediction",
                   classes: list | None = None) -> DataFrame:
    """E5 wide form: rows actual, one column per predicted class (column names need the class list)."""
    if classes is None:
        classes = [r["cls"] for r in class_table(df, label, pred).orderBy("i").collect()]
    long = confusion_long(df, label, pred, classes)
    cell = lambda c: F.sum(F.when(F.col("prediction").eqNullSafe(F.lit(c)), F.col("count")))
    return long.groupBy("label").agg(*[cell(c).alias("null" if c is None else str(c)) for c in classes])


def per_class_stats(df: DataFrame, label: str = "label", pred: str = "prediction",
                    classes: list | None = None) -> DataFrame:
    """Per class: precision, recall, f1, support. One aggregate over the k^2 confusion
    counts: each cell is credited to its true class (support, hits) and to its
    predicted class (predicted). Without ``classes``, those seen as label or prediction appear (null
    is one); with it exactly the given ones do, unseen ones with zeros."""
    counts = df.groupBy(F.col(label).alias("_y"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(F.lit(0))
    credited = counts.select(F.explode(F.array(
        F.struct(F.col("_y").alias("cls"), F.col("_n").alias("s"), F.lit(0).cast("bigint").alias("p"),
                 hit.cast("bigint").alias("t")),
        F.struct(F.col("_p").alias("cls"), F.lit(0).cast("bigint").alias("s"), F.col("_n").alias("p"),
                 F.lit(0).cast("bigint").alias("t")))).alias("c")).select("c.*")
    s = credited.groupBy("cls").agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"),
                                    F.sum("t").alias("tp"))
    if classes is not None:
        s = null_safe_join(class_table(df, label, pred, classes).drop("i"), s, "cls", "left").na.fill(0, ["support", "predicted", "tp"])
    prec = _div0(F.col("tp"), F.col("predicted"))
    rec = _div0(F.col("tp"), F.col("support"))
    return s.select(
        "cls", prec.alias("precision"), rec.alias("recall"),
        _div0(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
    )


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction",
                          classes: list | None = None) -> DataFrame:
    """Rows ``(row, precision, recall, f1, support)`` for every class, then
    ``accuracy``, ``macro avg`` and ``weighted avg`` (the sklearn report layout;
    the accuracy row carries accuracy in all three metric columns)."""
    pc = per_class_stats(df, label, pred, classes)
    cls_rows = pc.select(F.col("cls").cast("string").alias("row"), "precision", "recall", "f1", "support")
    tot = pc.agg(F.sum("support").alias("n"), F.sum(F.col("recall") * F.col("support")).alias("hits"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 F.sum(F.col("precision") * F.col("support")).alias("wp"),
                 F.sum(F.col("recall") * F.col("support")).alias("wr"),
                 F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = F.col("hits") / F.col("n")
    n = F.col("n").cast("bigint")
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        n.alias("support"))

    summary = tot.select(F.inline(F.array(
        row("accuracy", acc, acc, acc),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp") / F.col("n"), F.col("wr") / F.col("n"), F.col("wf") / F.col("n")),
    )))
    return cls_rows.unionByName(summary)


def weighted_prf(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Support-weighted precision / recall / F1."""
    pc = per_class_stats(df, label, pred)
    return pc.agg(*[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}")
                    for m in ("precision", "recall", "f1")])


def macro_f1(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Unweighted mean of per-class F1."""
    return per_class_stats(df, label, pred).agg(F.avg("f1").alias("macro_f1"))


def score_counts(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Positives and negatives per distinct score: the only table ROC work needs."""
    y = F.col(label) == F.lit(positive)
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y).cast("double").alias("pos"), F.count_if(~y).cast("double").alias("neg"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1,
            target_rows: int = TARGET_ROWS) -> DataFrame:
    """Exact ROC-AUC (Mann-Whitney with ties counted half); null with one class.

    Works on per-score counts, then an exact distributed running total of negatives."""
    sc = score_counts(df, label, score, positive)
    cum = running_totals(sc, "score", ["neg"], target_rows=target_rows)
    below = F.col("neg_cum") - F.col("neg")
    agg = cum.agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"),
                  F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(F.when((F.col("p") > 0) & (F.col("n") > 0),
                             F.col("u") / (F.col("p") * F.col("n"))).alias("roc_auc"))


def roc_auc_by(df: DataFrame, group_col: str, label: str = "label", score: str = "score", positive=1,
               target_rows: int = TARGET_ROWS) -> DataFrame:
    """E7 for many models at once: ``group_col, roc_auc`` from one running total per group."""
    y = F.col(label) == F.lit(positive)
    sc = df.groupBy(group_col, F.col(score).alias("score")).agg(F.count_if(y).cast("double").alias("pos"), F.count_if(~y).cast("double").alias("neg"))
    cum = running_totals(sc, "score", ["neg"], target_rows=target_rows, group_cols=[group_col])
    agg = cum.groupBy(group_col).agg(F.sum(F.col("pos") * (F.col("neg_cum") - 0.5 * F.col("neg"))).alias("u"),
                                     F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(group_col, F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("u") / (F.col("p") * F.col("n"))).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", positive=1,
              target_rows: int = TARGET_ROWS, drop_intermediate: bool = False) -> DataFrame:
    """One ``(threshold, fpr, tpr)`` point per distinct score (predict positive when
    ``score >= threshold``), plus the origin with a null threshold.

    ``drop_intermediate`` removes points collinear with both neighbours (a zero second
    difference of false and true positive counts), as sklearn does. Neighbours are found
    by an equi-join on the point's exact position (distributed running count), not by a
    window over the whole curve."""
    sc = score_counts(df, label, score, positive).withColumn("one", F.lit(1.0))
    tot = one_row(sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    cum = running_totals(sc, "score", ["pos", "neg", "one"], descending=True, target_rows=target_rows)
    pts = cum.select(F.col("score").alias("threshold"), F.col("pos_cum").alias("tps"), F.col("neg_cum").alias("fps"),
                     F.col("one_cum").cast("bigint").alias("i"))
    origin = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                             F.lit(0.0).alias("tps"), F.lit(0.0).alias("fps"),
                                             F.lit(0).cast("bigint").alias("i"))
    allp = origin.unionByName(pts)
    if drop_intermediate:
        prev = allp.select((F.col("i") + 1).alias("i"), F.col("tps").alias("tp0"), F.col("fps").alias("fp0"))
        nxt = allp.select((F.col("i") - 1).alias("i"), F.col("tps").alias("tp2"), F.col("fps").alias("fp2"))
        j = allp.join(prev, "i", "left").join(nxt, "i", "left")
        keep = (F.col("tp0").isNull() | F.col("tp2").isNull()
                | ((F.col("tp2") - 2 * F.col("tps") + F.col("tp0")) != 0)
                | ((F.col("fp2") - 2 * F.col("fps") + F.col("fp0")) != 0))
        allp = j.where(keep).select("threshold", "tps", "fps", "i")
    return allp.select("threshold", F.try_divide(F.col("fps"), F.lit(tot["N"])).alias("fpr"),
                       F.try_divide(F.col("tps"), F.lit(tot["P"])).alias("tpr"))


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                       n_features: int | None = None) -> DataFrame:
    """N, MAE, MSE, RMSE, R2 and (given the feature count) adjusted R2."""
    e = F.col(label) - F.col(pred)
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                 F.sum(e * e).alias("sse"), (F.var_pop(label) * F.count(F.lit(1))).alias("sst"))
    r2 = F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))
    cols = [F.col("n").cast("bigint").alias("n"), "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2")]
    if n_features is not None:
        k = F.lit(float(n_features))
        adj = F.lit(1.0) - (F.lit(1.0) - r2) * F.try_divide(F.col("n") - 1, F.col("n") - k - 1)
        cols.append(adj.alias("adj_r2"))
    return agg.select(*cols)


def metrics_long(wide: DataFrame, id_cols=(), name: str = "metric", value: str = "value") -> DataFrame:
    """One row per metric (``unpivot``)."""
    vals = [c for c in wide.columns if c not in id_cols]
    return wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in vals]).unpivot(
        list(id_cols), vals, name, value)


def residuals(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """``y - y_hat`` next to the prediction."""
    return df.withColumn("residual", F.col(label) - F.col(pred))


def comparison_table(long: DataFrame, model_col: str = "model", metric_col: str = "metric",
                     value_col: str = "value", metrics: list[str] | None = None,
                     digits: int = 4) -> DataFrame:
    """Long ``(model, metric, value)`` -> one row per model, one column per metric."""
    p = long.groupBy(model_col).pivot(metric_col, metrics).agg(F.first(round_half_up(value_col, digits)))
    return p


def best_by(df: DataFrame, name_col: str, *score_cols: str, minimize: bool = False) -> DataFrame:
    """Arg-max (or arg-min) row with a deterministic tie-break: the next
    score columns in turn, then the smallest name. A distributed top-1
    (``TakeOrderedAndProject``), never a sort of the whole table."""
    order = [F.col(c).asc() if minimize else F.col(c).desc() for c in score_cols]
    return df.orderBy(*order, F.col(name_col).asc()).limit(1)


def one_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate (model-sized) as a dict."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("expected exactly one row")
    return rows[0].asDict()


def gain_over(best: DataFrame, baseline: DataFrame, metric: str = "f1") -> DataFrame:
    """Difference of one metric between a candidate and a one-row baseline."""
    base = one_row(baseline.select(F.col(metric).alias("baseline")))["baseline"]
    return best.select(F.col(metric).alias("candidate"), F.lit(base).cast("double").alias("baseline"),
                       (F.col(metric) - F.lit(base)).alias("gain"))


def binary_metrics_by(df: DataFrame, group_col: str, label: str = "label", pred: str = "prediction",
                      positive=1) -> DataFrame:
    """Accuracy, precision, recall and F1 for many models in one
    aggregate (``groupBy(model)``) over a long prediction table."""
    y = F.col(label) == F.lit(positive)
    p = F.col(pred) == F.lit(positive)
    a = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"), F.count_if(y & p).alias("tp"),
                                  F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
                                  F.count_if(~y & ~p).alias("tn"))
    return a.select(
        group_col, ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def multiclass_metrics_by(df: DataFrame, group_col: str, label: str = "label",
                          pred: str = "prediction") -> DataFrame:
    """E13 input: accuracy and macro F1 per model from one aggregate over the
    (model, label, prediction) counts (models x classes^2 rows)."""
    counts = df.groupBy(group_col, F.col(label).alias("_y"), F.col(pred).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(F.lit(0)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    credited = counts.select(group_col, F.explode(F.array(
        F.struct(F.col("_y").alias("cls"), F.col("_n").alias("s"), zero.alias("p"), hit.alias("t")),
        F.struct(F.col("_p").alias("cls"), zero.alias("s"), F.col("_n").alias("p"), zero.alias("t")))).alias("c"))
    pc = credited.select(group_col, "c.*").groupBy(group_col, "cls").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("tp"))
    f1 = _div0(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    return pc.groupBy(group_col).agg((F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg(f1).alias("macro_f1"))
