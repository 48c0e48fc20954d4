"""Profiling aggregates.

Every profile is one pass (or a fixed few) over the table with partial + final
aggregation; per-column work is expressed in long form (``unpivot``) or as one
aggregate expression per column, never as a Python loop of jobs over columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.exprs import number
from tidemill.operators.joins import null_safe_join
from tidemill.operators.ordered import TARGET_ROWS, running_totals
from tidemill.operators.quantiles import quantiles


def _lit_map(values: dict, key_col: str):
    """CASE key WHEN k THEN v ... (literal per-column statistics)."""
    e = None
    for k, v in values.items():
        e = (F.when(F.col(key_col) == k, F.lit(v)) if e is None
             else e.when(F.col(key_col) == k, F.lit(v)))
    return e


def describe(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """A1: one row per column: count, mean, std (n-1), min, 25 %, 50 %, 75 %, max.
    One pass gives the moments and counts (d rows, model-sized); the quartiles reuse the
    counts, so the exact path costs one more job for columns that fit a task."""
    from tidemill.operators.quantiles import grouped_quantiles

    cols = list(cols)
    long = df.select(*[number(c).alias(c) for c in cols]).unpivot([], cols, "feature", "v")
    base = long.groupBy("feature").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max")).collect()
    if approx:
        q = quantiles(df, cols, [0.25, 0.5, 0.75], approx=True)
    else:
        q = grouped_quantiles(long, [0.25, 0.5, 0.75], counts={r["feature"]: r["count"] for r in base})
    rows = [(r["feature"], int(r["count"]), r["mean"], r["std"], r["min"],
             *(q.get(r["feature"]) or [None, None, None]), r["max"]) for r in base]
    return df.sparkSession.createDataFrame(
        rows, "feature string, count bigint, mean double, std double, min double, p25 double, p50 double, "
              "p75 double, max double")


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """A3: missing values per column in one pass; one row per column."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "missing_count")


def class_counts(df: DataFrame, col: str, classes: DataFrame | None = None) -> DataFrame:
    """A4: ``value_counts``; classes absent from the data are kept with 0 when a
    class dictionary is given."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    if classes is None:
        return counts
    return classes.join(counts, col, "left").select(col, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def rate(df: DataFrame, cond, name: str = "rate_pct") -> DataFrame:
    """A5: share of rows meeting ``cond``, in percent."""
    return df.agg((F.avg(cond.cast("double")) * 100).alias(name))


def basic_stats(df: DataFrame, cols) -> DataFrame:
    """Mean, median, mode (ties -> smallest), sample variance and deviation."""
    cols = list(cols)
    long = df.select(*[number(c).alias(c) for c in cols]).unpivot([], cols, "feature", "v")
    med = quantiles(df, cols, [0.5])
    mode = modes(df.select(*[number(c).alias(c) for c in cols]), cols)
    return long.groupBy("feature").agg(
        F.avg("v").alias("mean"), F.var_samp("v").alias("variance"), F.stddev_samp("v").alias("stdev"),
    ).select("feature", "mean", _lit_map({c: med[c][0] for c in cols}, "feature").cast("double").alias("median"),
             _lit_map(mode, "feature").cast("double").alias("mode"), "variance", "stdev")


def skew_kurt(df: DataFrame, cols) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis (pandas / DuckDB definitions);
    Spark's own ``skewness``/``kurtosis`` are the population values, corrected here."""
    cols = list(cols)
    long = df.select(*[number(c).alias(c) for c in cols]).unpivot([], cols, "feature", "v")
    a = long.groupBy("feature").agg(F.count("v").alias("n"), F.skewness("v").alias("g1"),
                                    F.kurtosis("v").alias("g2"))
    n = F.col("n").cast("double")
    skew = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3))
    return a.select("feature", F.when(n > 2, skew).alias("skewness"), F.when(n > 3, kurt).alias("kurtosis"))


def _safe_corr(a: str, b: str):
    """Pearson correlation over the rows where both are present (NaN counts as missing); a constant
    column gives null instead of an error."""
    x, y = F.when(number(b).isNotNull(), number(a)), F.when(number(a).isNotNull(), number(b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def pair_moments(df: DataFrame, cols) -> DataFrame:
    """``a, b, n, sx, sy, sxx, syy, sxy`` for every pair of columns over the rows where both are present,
    after subtracting column means (one aggregate) so that the sums keep their precision. Each task adds
    up one Gram matrix; only matrices are shuffled, whatever the number of rows."""
    cols = list(cols)
    means = df.agg(*[F.avg(number(c)).alias(c) for c in cols]).first()
    shift = np.array([means[c] if means[c] is not None else 0.0 for c in cols])

    def gram(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, len(cols), len(cols)))
        for frame in frames:
            x = frame.to_numpy(float) - shift
            m = (~np.isnan(x)).astype(float)
            x = np.where(m > 0, x, 0.0)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.indices(total.shape[1:])
        n, s, ss, p = total
        yield pd.DataFrame({"a": i.ravel(), "b": j.ravel(), "n": n.ravel(), "sx": s.ravel(), "sy": s.T.ravel(),
                            "sxx": ss.ravel(), "syy": ss.T.ravel(), "sxy": p.ravel()})

    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    part = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)]).mapInPandas(gram, "a int, b int, " + ", ".join(f"{c} double" for c in names))
    return part.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in names])


def corr_long(df: DataFrame, cols, upper_only: bool = False, diagonal: bool = True) -> DataFrame:
    """The correlation matrix as ``(feature_1, feature_2, corr)`` rows, each pair over the rows
    where both columns are present, for any number of columns. A constant column, or a pair that is never
    present together, gives null."""
    cols = list(cols)
    m = pair_moments(df, cols)
    m = m.where(F.col("a") < F.col("b")) if upper_only else m if diagonal else m.where(F.col("a") != F.col("b"))
    n, (sx, sy, sxx, syy, sxy) = F.col("n"), (F.col(c) for c in ("sx", "sy", "sxx", "syy", "sxy"))
    vx, vy = sxx - F.try_divide(sx * sx, n), syy - F.try_divide(sy * sy, n)
    # what rounding leaves of a constant column's variance is not variance
    real = (vx > 1e-14 * sxx) & (vy > 1e-14 * syy)
    r = F.when(real, F.try_divide(sxy - F.try_divide(sx * sy, n), F.sqrt(vx) * F.sqrt(vy)))
    name = F.array(*[F.lit(c) for c in cols])
    corr = F.when(F.col("a") == F.col("b"), F.when(vx > 1e-14 * sxx, F.lit(1.0))).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    corr = F.when(F.col("a") == F.col("b"), corr).when(r.isNotNull(), corr)  # least and greatest skip nulls
    return m.select(F.get(name, F.col("a")).alias("feature_1"), F.get(name, F.col("b")).alias("feature_2"), corr.alias("corr"))


def corr_with_target(df: DataFrame, cols, target: str) -> DataFrame:
    """Correlation of every feature with the target, one aggregate; each over the rows where
    both are present."""
    cols = [c for c in cols if c != target]
    wide = df.agg(*[_safe_corr(c, target).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "corr").withColumn("abs_corr", F.abs("corr"))


def top_abs_pairs(df: DataFrame, cols, k: int = 50) -> DataFrame:
    """A10: the ``k`` unordered feature pairs with the largest |corr| (ties by names)."""
    long = corr_long(df, cols, upper_only=True)
    return (long.select("feature_1", "feature_2", F.abs("corr").alias("abs_corr"))
            .orderBy(F.col("abs_corr").desc_nulls_last(), "feature_1", "feature_2").limit(k))


def class_feature_stats(df: DataFrame, groups: dict, label: str, neg=0, pos=1) -> DataFrame:
    """Per feature (with its group): mean and sample std in each of two classes and
    the absolute mean difference; one aggregate over the long form."""
    feats = [f for fs in groups.values() for f in fs]
    gmap = F.create_map(*[x for g, fs in groups.items() for f in fs for x in (F.lit(f), F.lit(g))])
    long = df.select(label, *[number(f).alias(f) for f in feats]).unpivot(
        [label], feats, "feature", "v")
    y = F.col(label)
    a = long.groupBy("feature").agg(
        F.avg(F.when(y == neg, F.col("v"))).alias("neg_mean"), F.avg(F.when(y == pos, F.col("v"))).alias("pos_mean"),
        F.stddev_samp(F.when(y == neg, F.col("v"))).alias("neg_std"),
        F.stddev_samp(F.when(y == pos, F.col("v"))).alias("pos_std"))
    return a.select(gmap[F.col("feature")].alias("group"), "feature", "neg_mean", "pos_mean",
                    F.abs(F.col("pos_mean") - F.col("neg_mean")).alias("mean_difference_abs"),
                    "neg_std", "pos_std")


def split_summary(df: DataFrame, split_col: str, n_features: int) -> DataFrame:
    """Rows per split with the feature count."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).cast("bigint").alias("rows")).withColumn(
        "features", F.lit(n_features).cast("bigint"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), one row per
    non-empty bin with its edges and count; a column without values gives no rows."""
    vals = df.select(number(col).alias("v")).where(F.col("v").isNotNull())
    mm = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = (mm["lo"], mm["hi"]) if mm["lo"] is not None else (0.0, 0.0)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)).cast("bigint"), F.lit(bins - 1))
    h = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return h.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
                    F.col("count").cast("bigint").alias("count"))


def box_stats(df: DataFrame, cols, class_col: str, approx: bool = False, task_rows: int | None = None) -> DataFrame:
    """Per (feature, class): quartiles, median and whiskers (the most extreme
    values inside the 1.5 IQR fences), fliers excluded; a null class is a class, a group without
    values has null statistics. Quartiles of groups that fit a task are a grouped aggregate and stay
    in Spark; larger groups (at most rows / ``task_rows`` of them) go through the exact distributed
    selection, or a sketch with ``approx``. Quartiles meet the rows in an equi-join."""
    from tidemill.operators.quantiles import TASK_ROWS, grouped_quantiles

    cols, probs, limit = list(cols), [0.25, 0.5, 0.75], task_rows or TASK_ROWS
    long = df.select(class_col, *[number(c).alias(c) for c in cols]).unpivot(
        [class_col], cols, "feature", "v")
    keys = ["feature", class_col]
    if approx:
        q = long.groupBy(*keys).agg(F.percentile_approx("v", probs, 100_000).alias("q"))
    else:
        sizes = long.groupBy(*keys).agg(F.count("v").alias("n"))
        big = sizes.where(F.col("n") > limit).collect()
        bounded = null_safe_join(long, sizes.where(F.col("n") <= limit).select(*keys), keys)
        q = bounded.groupBy(*keys).agg(F.percentile("v", probs).alias("q"))
        if big:
            tag = lambda f, c: F.concat_ws("\u0001", f, F.coalesce(c.cast("string"), F.lit("\u0002")))
            keyed = long.select(tag(F.col("feature"), F.col(class_col)).alias("feature"), "v")
            names = ["\u0001".join([r["feature"], "\u0002" if r[class_col] is None else str(r[class_col])]) for r in big]
            got = grouped_quantiles(keyed, probs, limit, counts={k: r["n"] for k, r in zip(names, big)})
            rows = df.sparkSession.createDataFrame([(r["feature"], r[class_col], got[k]) for k, r in zip(names, big)], q.schema)
            q = q.unionByName(rows)
    j = null_safe_join(long, q, keys)
    q1, med, q3 = (F.get("q", F.lit(i)) for i in range(3))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = (F.col("v") >= lo) & (F.col("v") <= hi)
    return j.groupBy(*keys).agg(
        F.first(q1).alias("q1"), F.first(med).alias("median"), F.first(q3).alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"), F.max(F.when(inside, F.col("v"))).alias("whisker_high"))


def modes(df: DataFrame, cols) -> dict:
    """Most frequent value per column, ties -> smallest, as a two-level aggregate:
    counts per (column, value) are shuffled by value, then one arg-max per column
    (partial aggregation keeps one candidate per task). No task holds a column's
    whole value map. Columns of one kind (numbers, texts) share a job."""
    out = dict.fromkeys(cols)
    kinds: dict[str, list] = {}
    for c in cols:
        t = df.schema[c].dataType.simpleString()
        kinds.setdefault("double" if t in ("tinyint", "smallint", "int", "bigint", "float", "double") else t, []).append(c)
    for kind, own in kinds.items():
        long = df.select(*[(number(c) if kind == "double" else F.col(c)).alias(c) for c in own]).unpivot([], own, "feature", "v")
        counts = long.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("_n"))
        for r in counts.groupBy("feature").agg(F.min_by("v", F.struct(-F.col("_n"), F.col("v"))).alias("m")).collect():
            whole = df.schema[r["feature"]].dataType.simpleString() not in ("float", "double")
            out[r["feature"]] = int(r["m"]) if kind == "double" and whole else r["m"]
    return out


def cumulative_sum(df: DataFrame, value_col: str, order_col: str, partition_cols=(), tie_cols=(),
                   out: str = "cumsum", bounded_groups: bool = False, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Running total, per group when ``partition_cols`` are given. Exact and
    distributed even for a hot group (range-partitioned running totals); with
    ``bounded_groups=True`` (groups known to be small, e.g. per-day aggregates) a
    plain partitioned window is used instead."""
    if partition_cols and bounded_groups:
        w = Window.partitionBy(*partition_cols).orderBy(order_col, *tie_cols).rowsBetween(
            Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value_col).over(w))
    return running_totals(df, order_col, [value_col], tie_cols=list(tie_cols), suffix="_cum",
                          group_cols=list(partition_cols), target_rows=target_rows).withColumnRenamed(f"{value_col}_cum", out)


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """``nunique`` (nulls not counted)."""
    f = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(f.cast("bigint").alias("n_unique"))


def r2_rating(r2_col) -> "F.Column":
    """Rating band of an R2 value."""
    # Fixed values (must equal the reference report): R2 above 0.8 Excellent, above 0.6 Good,
    # above 0.4 Moderate, otherwise Fair.
    r = F.col(r2_col) if isinstance(r2_col, str) else r2_col
    return (F.when(r > 0.8, "Excellent").when(r > 0.6, "Good").when(r > 0.4, "Moderate").otherwise("Fair"))
