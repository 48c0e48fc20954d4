"""Exact duplicates by distributed most-significant-digit radix partitioning.

Documents are split by successive runs of bytes. Round ``r`` groups the rows of every
open group by their next digit; a group that becomes a single row is unique, a group
whose texts end inside the digit is a group of equal texts, and only the rest goes on,
without the bytes already compared. Equality is decided by the bytes alone: no digest takes
part. Digits widen from round to round, so a text of ``n`` bytes takes ``O(log n)`` rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._shared import materialize, squeeze_space, text_or_empty, with_row_id

FIRST_DIGIT = 64
WIDEN = 8
LAST_DIGIT = 1 << 20


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after squeezing ASCII white space. Null and empty texts
    are equal to each other. The row with the smallest id stays (a null id sorts last; of rows
    repeating that id the first in the table stays, so a group always keeps one row).
    Columns of ``docs`` beyond the two named ones are ignored; an empty table gives no rows.

    Scale: a round shuffles the next digit (pre-aggregated, so a hot group of copies sends one
    row per task) and the unread bytes of open groups, joined on group and digit against one row
    per group; adaptive skew splitting divides a hot group's rows. After the first round only
    rows that share a prefix are left. No group is ever collected in one task.
    """
    norm = squeeze_space(text_or_empty(text_col))
    rows = with_row_id(docs.select(F.col(id_col).alias("_id"), F.col(text_col))).select(
        "_rid", "_id", F.sha2(norm, 256).alias("_sha"), norm.cast("binary").alias("_rest"))
    state = rows.withColumn("_gid", F.lit(0).cast("long"))
    width, done, rounds = FIRST_DIGIT, [], 0
    while state is not None:
        state = state.withColumn("_digit", F.substring("_rest", 1, width))
        counts = [F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_next")]
        if rounds:
            counts.append(F.min(F.struct(F.col("_id").isNull().alias("z"), F.col("_id").alias("i"),
                                         F.col("_rid").alias("r"))).alias("_keep"))
        groups = state.groupBy("_gid", "_digit").agg(*counts).where("_n > 1")
        joined = state.join(groups, ["_gid", "_digit"], "left")
        # the first round only splits: its groups come from the source, later ones from stored tables
        ends = (F.length("_digit") < width) if rounds else F.lit(False)
        alone = F.col("_n").isNull()
        final = alone | ends
        keep_rid = F.when(alone, F.col("_rid")).otherwise(F.col("_keep.r") if rounds else F.lit(None).cast("long"))
        keep_id = F.when(alone, F.col("_id")).otherwise(F.col("_keep.i") if rounds else F.lit(None).cast(rows.schema["_id"].dataType))
        out = materialize(joined.select(
            "_rid", "_id", "_sha", F.col("_next").alias("_gid"), final.alias("_final"),
            F.coalesce("_n", F.lit(1)).cast("long").alias("_size"), keep_rid.alias("_keep_rid"), keep_id.alias("_keep_id"),
            F.when(~final, F.expr(f"substring(_rest, {width + 1}, greatest(length(_rest), 1))")).alias("_rest")), f"radix-{rounds}")
        done.append(out.where("_final").select(
            F.col("_id").alias(id_col), F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"),
            (F.col("_rid") == F.col("_keep_rid")).alias("kept"), F.col("_sha").alias("text_sha256")))
        open_rows = out.where("NOT _final")
        state = None if open_rows.isEmpty() else open_rows.select("_rid", "_id", "_sha", "_rest", "_gid")
        width, rounds = min(width * WIDEN, LAST_DIGIT), rounds + 1
    return reduce(DataFrame.unionAll, done)
