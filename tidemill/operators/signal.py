"""Multichannel signal operators (W7, W8, F5, F6) as array expressions.

A recording is one row holding a flat channel-major array. Reshaping, window
cutting and the per-window statistics are higher-order array functions, so the
work is row-parallel inside codegen; no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reshape_channels(flat: Column, channels: int) -> Column:
    """Flat channel-major array -> ``array<array<double>>`` of shape
    [channels, timesteps]; raises when the length is not divisible."""
    t = F.size(flat) / F.lit(channels)
    checked = F.when(F.size(flat) % channels == 0, flat).otherwise(
        F.raise_error(F.lit(f"signal length is not divisible by {channels} channels"))
    )
    t_int = t.cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(channels - 1)),
        lambda c: F.transform(F.slice(checked, c * t_int + 1, t_int), lambda v: v.cast("double")),
    )


def _mav(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + F.abs(v)) / F.size(a)


def _rms(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v) / F.size(a))


def window_features(df: DataFrame, signal_col: str, max_window: int = 32,
                    min_len: int = 8, id_cols=()) -> DataFrame:
    """Sliding windows of size ``min(max_window, T)`` and step ``size // 2`` over
    a [channels, T] signal; one output row per window with MAV and RMS per channel
    (features ordered: all MAVs then all RMSs). Signals with ``T <= min_len`` bypass
    windowing and emit their raw values as one row."""
    sig = F.col(signal_col)
    t = F.size(sig[0])
    size = F.least(F.lit(max_window), t)
    step = F.greatest(F.floor(size / 2).cast("int"), F.lit(1))
    starts = F.when(t > min_len, F.sequence(F.lit(0), t - size, step)).otherwise(F.array(F.lit(-1)))
    exploded = df.select(*id_cols, signal_col, size.alias("_size"),
                         F.posexplode(starts).alias("window_index", "_start"))
    mav = F.transform(F.col(signal_col), lambda ch: _mav(F.slice(ch, F.col("_start") + 1, F.col("_size"))))
    rms = F.transform(F.col(signal_col), lambda ch: _rms(F.slice(ch, F.col("_start") + 1, F.col("_size"))))
    raw = F.flatten(F.col(signal_col))
    feats = F.when(F.col("_start") >= 0, F.concat(mav, rms)).otherwise(raw)
    return exploded.select(*id_cols, F.col("window_index").cast("int").alias("window_index"),
                           feats.alias("features"))


def array_mean(a: Column) -> Column:
    """mean of an array's elements."""
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double")) / F.size(a)
