"""Exact running totals in a global (or per-group) order without a single-task window
(A16, C10, E7, E8, T3, L7, and positions inside long series).

A window with no partition key sends every row to one task, and a window partitioned
by a hot key sends that key's rows to one task. Here rows are range-partitioned on the
full ordering (group keys, order column, tie columns) into ``ceil(n / target_rows)``
partitions: Spark's range partitioner places bounds on the composite key, so even a
single key holding a third of the rows is spread over many partitions of about
``target_rows`` rows each. Per-partition totals (one row per partition and group) give
each partition's offset; inside a partition the running total is an ordinary window.
Rows with identical ordering keys always share a partition, so the result is exact;
``(order_col, tie_cols)`` should be unique within a group for a well-defined order.

The partition number comes from ``spark_partition_id()`` right after the explicit range
repartition. The range partitioner samples with a seed derived from the RDD id, so two
evaluations of the same plan may draw different bounds: the partitioned rows are
therefore written once with a reliable ``checkpoint()`` into the shared checkpoint folder,
and the totals, the offsets and the final window (and any recomputation after an
executor loss) all read that one copy.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.joins import null_safe_join
from tidemill.session import cut_lineage

TARGET_ROWS = 1_000_000
BROADCAST_OFFSETS_MAX = 200_000
#: Partitions of fewer rows than ``TARGET_ROWS`` that are made at most: each is a task whose status reaches the driver.
SMALL_PARTS = 1_000


def range_partitioned(df: DataFrame, ordering: list, target_rows: int = TARGET_ROWS) -> tuple[DataFrame, int]:
    """Rows range-partitioned on ``ordering`` into about ``n / target_rows`` partitions, with the partition number as
    ``_bkt``. Where ``target_rows`` is small, beyond ``SMALL_PARTS`` of them partitions grow to up to ``TARGET_ROWS``
    rows before there are more."""
    n = df.count()
    rows = max(1, target_rows, min(TARGET_ROWS, math.ceil(n / SMALL_PARTS)))
    parts = max(1, math.ceil(n / rows))
    rp = df.repartitionByRange(parts, *ordering).withColumn("_bkt", F.spark_partition_id())
    return cut_lineage(rp), parts


def running_totals(df: DataFrame, order_col: str, value_cols: list[str], tie_cols=(), descending: bool = False,
                   target_rows: int = TARGET_ROWS, suffix: str = "_cum", group_cols=()) -> DataFrame:
    """Adds ``<v>_cum`` = sum of ``v`` over all rows up to and including this one in the
    order (``order_col``, then ``tie_cols``; ascending or descending), within each group
    of ``group_cols`` when given (otherwise over the whole table)."""
    groups = list(group_cols)
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    ordering = [F.col(g).asc() for g in groups] + [direction(order_col)] + [direction(t) for t in tie_cols]
    rp, parts = range_partitioned(df, ordering, target_rows)
    totals = rp.groupBy("_bkt", *groups).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    before = (Window.partitionBy(*groups) if groups else Window).orderBy("_bkt").rowsBetween(
        Window.unboundedPreceding, -1)
    # null while no value has come, as in a plain window sum
    offsets = totals.select("_bkt", *groups, *[F.sum(f"_t_{v}").over(before).alias(f"_o_{v}") for v in value_cols])
    if not groups and parts <= BROADCAST_OFFSETS_MAX:
        offsets = F.broadcast(offsets)  # one row per partition
    joined = null_safe_join(rp, offsets, ["_bkt", *groups], "left")  # a null group is a group
    w = Window.partitionBy("_bkt", *groups).orderBy(*ordering[len(groups):]).rowsBetween(
        Window.unboundedPreceding, 0)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[F.coalesce(F.sum(v).over(w) + F.col(f"_o_{v}"), F.sum(v).over(w), F.col(f"_o_{v}")).alias(f"{v}{suffix}") for v in value_cols],
    )
