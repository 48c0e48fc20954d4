"""Exact k-nearest-neighbour classification (M4, J3) without a cross join.

Train and query rows are grouped into blocks of about ``block_rows`` rows (hash of
the key, so no block is large). Every (query block, train block) pair meets once
through an equi-join on the train block number; inside that pair one vectorised
NumPy pass computes the exact distances and keeps only the ``k`` best per query.
Candidates are then reduced to the global top ``k`` per query (ties: distance, then
train id) and voted (ties: smallest label). No pair rows are ever materialised:
only ``k`` candidates per query per train block leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAND_SCHEMA = "qid bigint, tid bigint, tlabel double, dist double"
CHUNK_BYTES = 64 << 20      # working memory per chunk of queries


def squared_distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances between the rows of ``q`` and ``t`` by exact differences, one
    dimension at a time: the same sums for any number of dimensions and rows."""
    out = np.zeros((len(q), len(t)))
    for j in range(q.shape[1]):
        d = q[:, j][:, None] - t[:, j][None, :]
        out += d * d
    return out


def nearest(q: np.ndarray, t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and squared distances (as by ``squared_distances``) of the ``k`` rows of ``t`` nearest to each row of ``q``, ties to the
    earlier row. A matrix product tells, up to its largest rounding error, which rows can be among them; only these are measured."""
    own, other = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", t, t)
    with np.errstate(invalid="ignore"):
        rough = own[:, None] + other[None, :] - 2.0 * (q @ t.T)
    if k >= len(t) or not np.isfinite(rough).all():
        d2 = squared_distances(q, t)
        at = np.argsort(d2, axis=1, kind="stable")[:, :k]
        return at, np.take_along_axis(d2, at, axis=1)
    error = 4 * (q.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(own) + np.sqrt(other.max())) ** 2
    row, at = np.nonzero(rough <= (np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * error)[:, None])
    d2 = np.zeros(len(row))
    for j in range(q.shape[1]):
        d = q[row, j] - t[at, j]
        d2 += d * d
    by = np.lexsort((at, d2, row))
    first = np.searchsorted(row, np.arange(len(q)))  # a row's own stay side by side
    best = by[(first[:, None] + np.arange(k)).ravel()]
    return at[best].reshape(-1, k), d2[best].reshape(-1, k)


def query_chunk(n_t: int) -> int:
    """Queries per chunk so that the largest temporary stays within CHUNK_BYTES."""
    return int(max(1, min(4096, CHUNK_BYTES // max(n_t * 8, 1))))


def _blocks(df: DataFrame, id_col: str, cols, n_blocks: int, prefix: str, label: str | None = None) -> DataFrame:
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    blk = F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_blocks)).alias("blk")
    items = [F.col(id_col).cast("bigint").alias("i"), vec.alias("v")]
    if label:
        items.append(F.col(label).cast("double").alias("y"))
    g = df.select(blk, F.struct(*items).alias("it")).groupBy("blk").agg(
        F.array_sort(F.collect_list("it")).alias("items"))
    out = [F.col("blk").alias(f"{prefix}blk"), F.col("items.i").alias(f"{prefix}ids"),
           F.col("items.v").alias(f"{prefix}vecs")]
    if label:
        out.append(F.col("items.y").alias(f"{prefix}labels"))
    return g.select(*out)


def _pair_top_k(k: int):
    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                q_ids = np.asarray(row.q_ids, dtype=np.int64)
                t_ids = np.asarray(row.t_ids, dtype=np.int64)
                order = np.argsort(t_ids, kind="stable")  # ties on distance -> smaller train id
                t_ids = t_ids[order]
                t_lab = np.asarray(row.t_labels, dtype=np.float64)[order]
                tv = np.vstack(row.t_vecs)[order]
                qv = np.vstack(row.q_vecs)
                kk = min(k, len(t_ids))
                step = query_chunk(len(t_ids))
                for s in range(0, len(q_ids), step):
                    q = qv[s:s + step]
                    idx, d2 = nearest(q, tv, kk)
                    rows = np.repeat(np.arange(len(q)), kk)
                    out.append(pd.DataFrame({
                        "qid": q_ids[s:s + step][rows], "tid": t_ids[idx.ravel()],
                        "tlabel": t_lab[idx.ravel()], "dist": np.sqrt(d2.ravel())}))
            if out:
                yield pd.concat(out, ignore_index=True)
    return run


def knn_candidates(train: DataFrame, query: DataFrame, cols, label: str, train_id: str, query_id: str,
                   k: int = 5, block_rows: int = 4096) -> DataFrame:
    """Global top-k neighbours per query row: ``(qid, tid, tlabel, dist, rank)``."""
    n_tr = train.count()
    n_q = query.count()
    tb = max(1, math.ceil(n_tr / block_rows))
    qb = max(1, math.ceil(n_q / block_rows))
    t_blocks = _blocks(train, train_id, cols, tb, "t_", label)
    q_blocks = _blocks(query, query_id, cols, qb, "q_")
    # each query block meets every train block once (equi-join on the train block number)
    q_rep = q_blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(tb - 1))).alias("t_blk"))
    pairs = q_rep.join(t_blocks, "t_blk")
    cands = pairs.mapInPandas(_pair_top_k(k), CAND_SCHEMA)
    w = Window.partitionBy("qid").orderBy("dist", "tid")
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_classify(train: DataFrame, query: DataFrame, cols, label: str, train_id: str, query_id: str,
                 k: int = 5, block_rows: int = 4096) -> DataFrame:
    """``(query_id, prediction, vote_share)``: uniform vote of the k nearest, ties to
    the smallest label."""
    c = knn_candidates(train, query, cols, label, train_id, query_id, k, block_rows)
    votes = c.groupBy("qid", "tlabel").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("qid").orderBy(F.col("votes").desc(), F.col("tlabel").asc())
    best = votes.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return best.select(F.col("qid").alias(query_id), F.col("tlabel").alias("prediction"),
                       (F.col("votes") / F.lit(float(k))).alias("vote_share"))
