"""Cleaning operators.

Statistics used for filling (mean, median, mode) come from one aggregate job; the
per-column values are model-sized and are applied as literals in a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exprs import coerce_double, null_sentinels, number
from tidemill.functions.hashing import hash_hex
from tidemill.operators.quantiles import quantiles

BROADCAST_KEYS_MAX = 100_000


def replace_sentinels(df: DataFrame, cols, tokens=("_", "")) -> DataFrame:
    """Whole-cell sentinel values -> null."""
    cols = set(cols)
    return df.select(*[null_sentinels(c, tokens).alias(c) if c in cols else F.col(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """``to_numeric(errors='coerce')`` for the given columns."""
    cols = set(cols)
    return df.select(*[coerce_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _fill(df: DataFrame, values: dict) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def impute_mean(df: DataFrame, cols) -> DataFrame:
    """Mean imputation per column (one aggregate for all columns)."""
    row = df.agg(*[F.avg(number(c)).alias(c) for c in cols]).first().asDict()
    return _fill(df, {c: v for c, v in row.items() if v is not None})


def impute_median(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """C4: median imputation; a column whose median is missing is filled with 0.
    Exact by default (distributed selection), ``approx=True`` uses a sketch."""
    meds = quantiles(df, cols, [0.5], approx=approx)
    return _fill(df, {c: (meds[c][0] if meds[c][0] is not None else 0.0) for c in cols})


def impute_mode(df: DataFrame, cols, fallback: str = "Unknown") -> DataFrame:
    """Most frequent value (ties -> smallest); an all-null column gets ``fallback``."""
    from tidemill.operators.profile import modes

    m = modes(df, cols)
    return _fill(df, {c: (v if v is not None else fallback) for c, v in m.items()})


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    """``dropna()``. (Counts of dropped rows come from an ordinary aggregate;
    ``DataFrame.observe`` is avoided: once a session has an observation manager, fitted
    MLlib models that keep a training summary fail task serialization in Spark 4.1.)"""
    return df.na.drop("any", subset=subset)


def drop_duplicate_rows(df: DataFrame, subset=None) -> DataFrame:
    """Exact duplicate rows removed (hash aggregate with map-side combine)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop id columns when they exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def rename_first_matching(df: DataFrame, needle: str, new_name: str) -> DataFrame:
    """Rename the first column whose lower-cased name contains ``needle``."""
    for c in df.columns:
        if needle in c.lower():
            return df.withColumnRenamed(c, new_name)
    raise ValueError(f"no column contains {needle!r}")


def iqr_bounds(df: DataFrame, cols, approx: bool = False, k: float = 1.5) -> dict:
    """C11: per column (q1, q3, lower fence, upper fence)."""
    qs = quantiles(df, cols, [0.25, 0.75], approx=approx)
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        iqr = None if q1 is None else q3 - q1
        out[c] = (q1, q3, None, None) if q1 is None else (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


def iqr_outliers(df: DataFrame, cols, approx: bool = False, k: float = 1.5) -> DataFrame:
    """C11: one row per column: quartiles, fences and the number of rows outside
    them (a column without values has null fences and none outside). Rows are kept; the counts come from one more aggregate."""
    b = iqr_bounds(df, cols, approx, k)

    def per_feature(i):
        return F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(b[c][i]).cast("double"))])[F.col("feature")]

    long = df.select(*[number(c).alias(c) for c in cols]).unpivot([], cols, "feature", "v")
    lo, hi = per_feature(2), per_feature(3)
    agg = long.groupBy("feature").agg(F.count_if((F.col("v") < lo) | (F.col("v") > hi)).alias("n_outliers"))
    return agg.select("feature", per_feature(0).alias("q1"), per_feature(1).alias("q3"), lo.alias("lower"),
                      hi.alias("upper"), F.col("n_outliers").cast("bigint").alias("n_outliers"))


def row_index(df: DataFrame, order_col: str, tie_cols=(), descending: bool = False,
              out: str = "row_no") -> DataFrame:
    """1-based position in an explicit global order, computed as an exact
    distributed running count (no single-partition window)."""
    from tidemill.operators.ordered import running_totals

    tagged = df.withColumn("_one", F.lit(1))
    r = running_totals(tagged, order_col, ["_one"], tie_cols=list(tie_cols), descending=descending)
    return r.drop("_one").withColumnRenamed("_one_cum", out).withColumn(out, F.col(out).cast("bigint"))


def inject_nulls_n(df: DataFrame, col: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """L9 (exact form): null in the ``n`` rows with the smallest ``md5(key|seed)``.
    Small n: the n keys come from a distributed top-n and are broadcast (bounded by
    ``BROADCAST_KEYS_MAX``). Large n: exact hash ranks, no key set moves at all."""
    from tidemill.operators.sampling import rank_within

    if n <= BROADCAST_KEYS_MAX:
        picked = (df.select(key, hash_hex(key, seed).alias("_h")).orderBy("_h", key).limit(n)
                  .select(key, F.lit(True).alias("_hit")))
        joined = df.join(F.broadcast(picked), key, "left")
    else:
        r = rank_within(df.withColumn("_all", F.lit(0)), "_all", key, seed)
        joined = r.withColumn("_hit", F.col("_rank") <= n)
    return joined.select(*[F.when(F.col("_hit"), F.lit(None)).otherwise(F.col(c)).alias(c) if c == col
                           else F.col(c) for c in df.columns])


def aligned_divide(a: DataFrame, b: DataFrame, key: str, a_col: str, b_col: str,
                   out: str = "ratio") -> DataFrame:
    """Index-aligned ``a / b``: full outer join on the key; unmatched or zero
    denominators give null."""
    j = a.select(key, F.col(a_col).alias("_a")).join(b.select(key, F.col(b_col).alias("_b")), key, "full_outer")
    return j.select(key, F.col("_a").alias(a_col), F.col("_b").alias(b_col),
                    F.try_divide(F.col("_a"), F.col("_b")).alias(out))


def keep_surviving(target: DataFrame, survivors: DataFrame, key: str) -> DataFrame:
    """Keep target rows whose key survived a filter (left semi join)."""
    return target.join(survivors.select(key), key, "left_semi")
