"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are turned by one fixed random rotation and split into low-dimensional blocks. If
two vectors lie within squared distance ``t``, some block holds at most its proportional share
of ``t`` (pigeonhole), so joining every block over its own small radius and verifying the union
of candidates by the cosine of the whole vectors in double precision finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemill.llm._shared import materialize, with_row_id
from tidemill.llm.graph import components

MIN_COSINE = 0.93
BLOCK_DIMS = 8
#: Vectors that one side of a task holds.
TASK_VECTORS = 32_768
#: Vectors of a label up to which one task compares them all.
CELL_VECTORS = 32_768
#: Pairs whose block distances a task holds at a time.
SLICE_PAIRS = 1 << 22
#: What single precision may add to the squared distance of two unit vectors in a block.
FLOAT_SLACK = 1e-5


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


def block_slices(dims: int, block_dims: int) -> list[slice]:
    return [slice(i, min(i + block_dims, dims)) for i in range(0, dims, block_dims)]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of ``n`` nodes reaches over the links ``a - b``."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            return root


def deal_pairs(reps: DataFrame, threshold: float, slack: float, block_dims: int, task_vectors: int, cell_vectors: int) -> DataFrame:
    """``_group, _role, _rep, _n, _v``: the rows of ``reps`` (``_label, _v, _rep, _n``) as those who ask (role 0) and as those
    who are looked at (role 1). A label of more than ``cell_vectors`` rows is dealt into runs of about ``task_vectors`` by hash, and
    every pair of runs is a group. A group sees all blocks of its pairs, so a vector travels twice per run and not once
    per block too; the radius (``threshold``, ``slack``, ``block_dims``) leaves no pair of runs out."""
    dealt = reps.withColumn("_dims", F.size("_v"))
    large = dealt.groupBy("_label", "_dims").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > cell_vectors)
    runs = large.select("_label", "_dims", F.ceil(F.col("_rows") / task_vectors).cast("long").alias("_runs"))
    dealt = dealt.join(F.broadcast(runs), ["_label", "_dims"], "left").withColumn("_runs", F.coalesce("_runs", F.lit(1).cast("long")))
    dealt = dealt.withColumn("_run", F.pmod(F.xxhash64("_rep"), "_runs"))
    each = "transform(sequence(0L, _runs - 1), i -> struct(concat_ws('|', cast(_label as string), _dims, {}) as _group, {} as _role))"
    both = F.expr(f"concat({each.format('_run, i', 0)}, {each.format('i, _run', 1)})")
    return dealt.withColumn("_to", F.explode(both)).select("_to._group", "_to._role", "_rep", "_n", "_v")


def near_pairs(x: np.ndarray, y: np.ndarray, block_dims: int, threshold: float, min_cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(i, j)``, slice by slice: rows of the unit vectors ``x`` and ``y`` whose cosine is at least ``min_cosine``. Pairs that lie
    within a block's share of ``threshold`` in some block are compared whole, in double precision."""
    dims = x.shape[1]
    tx, ty = x @ rotation(dims), y @ rotation(dims)
    squares = lambda v, s: (v[:, s] ** 2).sum(1, keepdims=True)
    sides = [(np.hstack([tx[:, s], squares(tx, s), np.ones((len(x), 1))]).astype(np.float32),
              np.hstack([-2 * ty[:, s], np.ones((len(y), 1)), squares(ty, s)]).astype(np.float32).T,
              np.float32(threshold * (s.stop - s.start) / dims + FLOAT_SLACK)) for s in block_slices(dims, block_dims)]
    step = max(1, SLICE_PAIRS // len(y))
    for top in range(0, len(x), step):
        close = np.zeros((min(step, len(x) - top), len(y)), bool)
        for left, right, budget in sides:
            close |= left[top:top + step] @ right <= budget
        if np.count_nonzero(close) * 64 > close.size:  # crowded: one product rules out most that are clearly too far
            close &= x[top:top + step] @ y.T >= min_cosine - 1e-9
        i, j = np.nonzero(close)
        for lo in range(0, len(i), 200_000):
            p, q = i[lo:lo + 200_000] + top, j[lo:lo + 200_000]
            hit = np.einsum("ij,ij->i", x[p], y[q]) >= min_cosine
            yield p[hit], q[hit]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 min_cosine: float = MIN_COSINE, block_dims: int = BLOCK_DIMS, task_vectors: int = TASK_VECTORS,
                 cell_vectors: int = CELL_VECTORS) -> DataFrame:
    """One row per input row: ``id_col, n_links, component_id, kept``.

    Rows link when labels are equal and not null, the vectors have equally many dimensions and
    their cosine is at least ``min_cosine``. A null or empty vector, a zero one, or one with a
    null or non-finite component links with nothing; such a row is its own component. Equal
    vectors of a label are collapsed before the join and count as links of each other.
    A null id never becomes a component id unless a component has no other. ``vectors`` must be
    stored; its other columns are ignored.

    Scale: a label of up to ``cell_vectors`` different vectors is one task, which sees all blocks, so a vector travels twice
    in the width it was given in. A larger label is cut into runs of about ``task_vectors``, and each pair of runs is a task: a vector
    travels twice per run, so the rows dealt grow with the square of a label only beyond that size, and comparisons
    with the square of a label: blocks of vectors in no order rule out pairs, not regions. Pairs are worked through in slices, so
    tasks stay bounded for any hot label or dense cluster, and never leave a task: it returns link counts
    and at most one connecting link per vector and task.
    """
    item = getattr(vectors.schema[vector_col].dataType, "elementType", None)
    kind = "float" if isinstance(item, FloatType) else "double"  # floats stay as narrow as they are until a task widens them
    base = with_row_id(vectors.select(F.col(id_col).alias("_id"), F.transform(F.col(vector_col).cast(f"array<{kind}>"), lambda x: x + F.lit(0.0).cast(kind)).alias("_v"), F.col(label_col).alias("_label")))
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("_v", lambda x: x != 0)
    usable = F.col("_label").isNotNull() & F.col("_v").isNotNull() & (F.size("_v") > 0) & ~F.coalesce(bad, F.lit(True))
    usable_rows = base.where(usable).withColumn("_key", F.unhex(F.sha2(F.concat_ws("|", F.col("_label").cast("string"), F.to_json("_v")), 256)))
    reps = materialize(usable_rows.groupBy("_label", "_v").agg(F.min("_rid").alias("_rep"), F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_key")), "vectors")
    threshold = 2.0 * (1.0 - min_cosine)

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"_rep": pd.Series(dtype="int64"), "_links": pd.Series(dtype="int64"), "_other": pd.Series(dtype="int64")})
        ask, see = frame[frame["_role"] == 0], frame[frame["_role"] == 1]
        if not len(ask) or not len(see):
            return out
        x, y = (unit(np.stack(f["_v"].to_list()).astype(float)) for f in (ask, see))
        links, weight = np.zeros(len(x), np.int64), see["_n"].to_numpy()
        ask_rep, see_rep = ask["_rep"].to_numpy(), see["_rep"].to_numpy()
        name, at = np.unique(np.concatenate([ask_rep, see_rep]), return_inverse=True)
        root = np.arange(len(name))
        for p, q in near_pairs(x, y, block_dims, threshold, min_cosine):
            other = ask_rep[p] != see_rep[q]
            p, q = p[other], q[other]
            np.add.at(links, p, weight[q])
            a, b = root[at[p]], root[at[len(ask) + q]]
            if (a != b).any():
                root = local_roots(len(name), a[a != b], b[a != b])[root]
        total = np.zeros(len(name), np.int64)
        total[at[:len(ask)]] = links
        found = (total > 0) | (root != np.arange(len(name)))
        return pd.DataFrame({"_rep": name[found], "_links": total[found], "_other": name[root[found]]})

    dealt = deal_pairs(reps, threshold, FLOAT_SLACK, block_dims, task_vectors, cell_vectors)
    found = materialize(dealt.groupBy("_group").applyInPandas(compare, "_rep long, _links long, _other long"), "vector-links")
    links = found.groupBy("_rep").agg(F.sum("_links").alias("_links"))
    roots = components(found.where("_rep != _other").select(F.col("_rep").alias("a"), F.col("_other").alias("b")))
    per = (reps.select("_key", "_rep", "_n").join(links, "_rep", "left")
           .join(roots.withColumnRenamed("node", "_rep"), "_rep", "left").withColumn("root", F.coalesce("root", "_rep")))
    rows = usable_rows.select("_id", "_rid", "_key").join(per, "_key").select(
        "_id", "_rid", (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).alias("n_links"), "root")
    rest = base.where(~usable).select("_id", "_rid", F.lit(0).cast("long").alias("n_links"), F.col("_rid").alias("root"))
    rows = materialize(rows.unionAll(rest), "vector-rows")
    first = rows.groupBy("root").agg(F.min("_id").alias("component_id"), F.min(F.struct(F.col("_id").isNull(), "_id", "_rid"))["_rid"].alias("_first"))
    return rows.join(first, "root").select(F.col("_id").alias(id_col), "n_links", "component_id", (F.col("_rid") == F.col("_first")).alias("kept"))
