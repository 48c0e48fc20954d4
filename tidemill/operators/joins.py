"""Equi-joins in which null keys meet null keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` with ``<=>``: a null key matches a null key. Spark plans it as an
    ordinary hash or sort-merge equi-join. Key columns are taken from ``left``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    other = right.select(*[F.col(c).alias(f"_ns_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_ns_{k}")) for k in keys])
    return left.join(other, cond, how).drop(*[f"_ns_{k}" for k in keys])
