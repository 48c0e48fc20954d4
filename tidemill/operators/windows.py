"""Window operators over ordered series.

Every window is partitioned by explicit series keys: a window without a partition
key plans ``Exchange SinglePartition`` and runs in one task. All features of one
series are produced in one ``select`` so they share one exchange and one sort.
Callers aggregate to one row per (series, period) first, so the windowed table is
bounded by periods x series, not by raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.operators.joins import null_safe_join


def _keys(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def series_window(series_cols, order_cols) -> WindowSpec:
    keys = _keys(series_cols)
    if not keys:
        raise ValueError("series windows need partition keys (a global window runs in one task)")
    return Window.partitionBy(*keys).orderBy(*_keys(order_cols))


def lag_col(col: str, w: WindowSpec, n: int = 1) -> Column:
    """``shift(n)``."""
    return F.lag(col, n).over(w)


def lead_col(col: str, w: WindowSpec, n: int = 1) -> Column:
    """``shift(-n)`` (forecast target)."""
    return F.lead(col, n).over(w)


def padded_cur_prev(col: str, w: WindowSpec) -> tuple[Column, Column]:
    """Current and previous value with nulls padded forward (inputs of W3)."""
    cur = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    prev = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return cur, prev


def pct_from(cur: Column, prev: Column) -> Column:
    return F.when(cur.isNull() | prev.isNull(), F.lit(0.0)).otherwise(F.try_divide(cur, prev) - 1)


def pct_change_col(col: str, w: WindowSpec) -> Column:
    """``pct_change().fillna(0)``: nulls padded forward first; first row 0.
    A zero base gives null (the reference gives inf)."""
    return pct_from(*padded_cur_prev(col, w))


def rolling_lag_col(col: str, w: WindowSpec, k: int, fn: str = "mean") -> Column:
    """``shift(1).rolling(k).mean()`` / ``.std()``: the k rows before the
    current one; null unless all k are present (pandas ``min_periods=k``)."""
    frame = w.rowsBetween(-k, -1)
    agg = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}[fn]
    return F.when(F.count(col).over(frame) == k, agg(col).over(frame))


def ffill_bfill_col(col: str, w: WindowSpec) -> Column:
    """``ffill().bfill()`` in series order."""
    fwd = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    back = F.first(col, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(fwd, back)


def add_series_features(df: DataFrame, series_cols, order_col: str, value_col: str,
                        ma=(5, 10), vol=(5,)) -> DataFrame:
    """W1-W5 together: previous value, next value (target), percent change, moving
    averages and volatility of the lagged value; one exchange + sort for all."""
    w = series_window(series_cols, order_col)
    return with_series_features(df, w, value_col, ma, vol)


def with_series_features(df: DataFrame, w: WindowSpec, value_col: str, ma=(5, 10), vol=(5,)) -> DataFrame:
    """The W1-W5 columns over window ``w``; every window expression is evaluated once
    (the percent change reads the padded current/previous values from columns)."""
    cur, prev = padded_cur_prev(value_col, w)
    cols = [
        lag_col(value_col, w).alias(f"prev_{value_col}"),
        lead_col(value_col, w).alias(f"next_{value_col}"),
        cur.alias("_cur"), prev.alias("_prev"),
    ]
    cols += [rolling_lag_col(value_col, w, k, "mean").alias(f"ma_{k}") for k in ma]
    cols += [rolling_lag_col(value_col, w, k, "std").alias(f"volatility_{k}") for k in vol]
    out = df.select("*", *cols)
    names = [c for c in out.columns if c not in ("_cur", "_prev")]
    ret = pct_from(F.col("_cur"), F.col("_prev")).alias(f"{value_col}_return")
    pos = names.index(f"next_{value_col}") + 1
    return out.select(*names[:pos], ret, *names[pos:])


def chronological_split(df: DataFrame, series_cols, order_col: str, train_frac: float = 0.8,
                        split_col: str = "split", tie_cols=(), block_rows: int = 1_000_000,
                        bounded_series: bool = False) -> DataFrame:
    """First ``int(frac * n)`` rows of each series (in order) are ``train``; a null key is a series.
    Positions inside each series are exact and bounded per task even for a hot series
    (``blocked_series.series_positions``). ``bounded_series`` says that every series is known to
    be short (periods of an aggregate): position and length then come from one exchange."""
    from tidemill.operators.blocked_series import series_positions

    keys = _keys(series_cols)
    order = _keys(order_col)
    if bounded_series:
        whole = Window.partitionBy(*keys)
        pos = F.row_number().over(whole.orderBy(*order, *tie_cols)) - 1
        first = pos < F.floor(F.count(F.lit(1)).over(whole) * F.lit(train_frac))
        return df.withColumn(split_col, F.when(first, F.lit("train")).otherwise(F.lit("test")))
    pos = series_positions(df, keys, order[0], list(order[1:]) + list(tie_cols),
                           target_rows=block_rows, small_max=block_rows)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    j = null_safe_join(pos, sizes, keys)
    return j.withColumn(split_col, F.when(F.col("_pos") < F.floor(F.col("_n") * F.lit(train_frac)), F.lit("train"))
                        .otherwise(F.lit("test"))).drop("_pos", "_n")


def chronological_split_global(df: DataFrame, order_col: str, tie_cols=(), train_frac: float = 0.8,
                               split_col: str = "split") -> DataFrame:
    """L6 for one table-wide order: the first ``int(frac * n)`` rows are ``train``.
    Positions come from an exact distributed running count (no single-partition sort)."""
    from tidemill.operators.clean import row_index

    n = df.count()
    cut = int(n * train_frac)
    idx = row_index(df, order_col, tie_cols=list(tie_cols), out="_row_no")
    return idx.withColumn(split_col, F.when(F.col("_row_no") <= cut, F.lit("train")).otherwise(F.lit("test"))).drop(
        "_row_no")


def top_k_per_group(df: DataFrame, group_cols, order_cols, k: int) -> DataFrame:
    """``sort.groupby(g).head(k)``: a rank filter Spark plans as a
    ``WindowGroupLimit`` before the exchange, so only k rows per group move."""
    w = Window.partitionBy(*_keys(group_cols)).orderBy(*_keys(order_cols))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def first_per_class(df: DataFrame, class_col: str, order_col: str,
                    classes: DataFrame | None = None) -> DataFrame:
    """First row of each class in table order; classes absent from the data are
    kept (with null values) when a class dictionary is given."""
    one = top_k_per_group(df, class_col, order_col, 1)
    if classes is None:
        return one
    return classes.join(one, class_col, "left")
