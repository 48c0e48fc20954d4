"""Nearest neighbours by vantage-point trees, one tree per shard.

Rows are dealt by hash to shards of bounded size. A shard's tree halves its unit vectors by their
distance from a vantage point and keeps the least and largest distance of both halves, so the
triangle inequality bounds how near a half can come to a query. A half is skipped when that bound
times ``factor`` exceeds the distance of the query's k-th best row so far: factor 1 is exact, a
larger factor looks at less and may miss rows. Queries travel in blocks, and a block meets a run of
shards in one task, which carries its best rows from shard to shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm._shared import materialize

SHARD_ROWS = 8192
QUERY_ROWS = 1024
#: Shards that a block of queries meets in one task.
TASK_SHARDS = 4
LEAF_ROWS = 128
#: Covers the rounding of distances between unit vectors, and of products of matrices against sums in order.
SLACK = 1e-6
CLOSE = 1e-12

NODE_FIELDS = ("lo", "hi", "vantage", "inner", "outer", "inner_lo", "inner_hi", "outer_lo", "outer_hi")
SHARD_SCHEMA = "dims int, shard long, nodes binary, vectors binary, ids binary, id_starts binary"
BLOCK_SCHEMA = "dims int, block long, ids binary, vectors binary"
FOUND_SCHEMA = "dims int, block long, place int, query_id long, vec_id long, score double"


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of ``a`` with the rows of ``b`` in double precision, products added in the order of
    the components: the same value wherever a pair meets."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for j in range(a.shape[1]):
        x, y = a[:, j], b[:, j]
        dot += x * y
        aa += x * x
        bb += y * y
    return np.clip(dot / np.sqrt(aa * bb), -1.0, 1.0)


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


@dataclass
class Tree:
    """Vectors in tree order (a leaf is a slice), the nodes, and the ids of each vector."""

    vectors: np.ndarray
    nodes: np.ndarray
    ids: np.ndarray
    id_starts: np.ndarray

    def __post_init__(self):
        self.unit = unit(self.vectors)


def build(ids: np.ndarray, raw: np.ndarray, keep_ids: int, leaf_rows: int = LEAF_ROWS, seed: int = 0) -> Tree:
    """Tree over the different vectors of a shard; of rows with equal vectors the ``keep_ids`` smallest ids are
    kept (no query returns more of them, since equal vectors are ranked by id)."""
    order = np.lexsort((ids, *raw.T[::-1]))
    ids, raw = ids[order], raw[order]
    new = np.ones(len(ids), bool)
    new[1:] = (raw[1:] != raw[:-1]).any(axis=1)
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    kept = np.arange(len(ids)) - starts[group] < keep_ids
    per = np.bincount(group[kept], minlength=len(starts))
    ids, raw = ids[kept], raw[starts]
    rng, points = np.random.default_rng(seed), unit(raw)
    perm, nodes, todo = np.arange(len(raw)), [], [(0, len(raw), None, 0)]
    while todo:
        lo, hi, parent, field = todo.pop()
        at = len(nodes)
        nodes.append([lo, hi, -1, -1, -1, 0, 0, 0, 0])
        if parent is not None:
            nodes[parent][field] = at
        if hi - lo <= leaf_rows:
            continue
        part = perm[lo:hi]
        vantage = part[rng.integers(len(part))]
        far = distances(points[part], points[vantage][None, :])[:, 0]
        by = np.argsort(far, kind="stable")
        half = (hi - lo) // 2
        perm[lo:hi], far = part[by], far[by]
        nodes[at][2], nodes[at][5:] = vantage, [far[0], far[half - 1], far[half], far[-1]]
        todo += [(lo, lo + half, at, 3), (lo + half, hi, at, 4)]
    place = np.empty(len(perm), np.int64)
    place[perm] = np.arange(len(perm))
    table = np.array(nodes, float)
    inside = table[:, 2] >= 0
    table[inside, 2] = place[table[inside, 2].astype(int)]
    first = np.concatenate([[0], np.cumsum(per)])
    spread = np.concatenate([np.arange(first[g], first[g + 1]) for g in perm]) if len(perm) else np.zeros(0, np.int64)
    return Tree(raw[perm], table, ids[spread], np.concatenate([[0], np.cumsum(per[perm])]))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Best:
    """The ``k`` best rows so far of each query of a block, best first (ties: smaller id)."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, k: int):
        self.ids, self.raw, self.unit, self.k = ids, raw, unit(raw), k
        self.score = np.full((len(ids), k), -np.inf)
        self.row = np.full((len(ids), k), np.iinfo(np.int64).max)

    def reach(self, q: np.ndarray) -> np.ndarray:
        """Distance within which a row of query ``q`` can still enter."""
        worst = self.score[q, -1]
        return np.where(np.isfinite(worst), np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.maximum(worst, -1.0))), np.inf)

    def offer(self, q: np.ndarray, tree: Tree, lo: int, hi: int) -> None:
        near = self.unit[q] @ tree.unit[lo:hi].T
        i, j = np.nonzero(near >= self.score[q, -1][:, None] - CLOSE * 100)
        if not len(i):
            return
        score = cosine(self.raw[q[i]], tree.vectors[lo + j])
        n = tree.id_starts[lo + j + 1] - tree.id_starts[lo + j]
        pair = np.repeat(np.arange(len(i)), n)
        row = tree.ids[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + tree.id_starts[lo + j][pair]]
        at, score = i[pair], score[pair]
        other = row != self.ids[q[at]]
        at, score, row = at[other], score[other], row[other]
        hit = np.unique(at)
        at = np.concatenate([np.repeat(hit, self.k), at])
        score = np.concatenate([self.score[q[hit]].ravel(), score])
        row = np.concatenate([self.row[q[hit]].ravel(), row])
        by = np.lexsort((row, -score, at))
        at, score, row = at[by], score[by], row[by]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < self.k
        self.score[q[at[top]], rank[top]] = score[top]
        self.row[q[at[top]], rank[top]] = row[top]


def bounds(tree: Tree, node: np.ndarray, q_unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least distance from each query to anything in the inner and outer half (triangle inequality)."""
    d = distances(q_unit, tree.unit[int(node[2])][None, :])[:, 0]
    zero = np.zeros(len(d))
    return np.maximum.reduce([zero, d - node[6], node[5] - d]), np.maximum.reduce([zero, d - node[8], node[7] - d])


def search(tree: Tree, best: Best, factor: float) -> int:
    """Offer the rows of ``tree`` to the queries of ``best``; returns the number of pairs of vectors looked at.

    Each query first visits the leaf it falls into, which gives it a reach; then the whole tree is walked with
    every query that the bounds cannot keep out."""
    if not len(tree.vectors):
        return 0
    looked, home = 0, np.full(len(best.ids), -1)
    todo = [(0, np.arange(len(best.ids)))]
    while todo:
        at, q = todo.pop()
        node = tree.nodes[at]
        if node[2] < 0:
            home[q] = at
            best.offer(q, tree, int(node[0]), int(node[1]))
            looked += len(q) * int(node[1] - node[0])
            continue
        inner, outer = bounds(tree, node, best.unit[q])
        looked += len(q)
        todo += [(int(node[f]), part) for f, part in ((3, q[inner <= outer]), (4, q[inner > outer])) if len(part)]
    todo = [(0, np.arange(len(best.ids)), np.zeros(len(best.ids)))]
    while todo:
        at, q, least = todo.pop()
        open_ = least * factor <= best.reach(q) + SLACK
        q, least, node = q[open_], least[open_], tree.nodes[at]
        if node[2] < 0:
            q = q[home[q] != at]
            if len(q):
                best.offer(q, tree, int(node[0]), int(node[1]))
                looked += len(q) * int(node[1] - node[0])
        elif len(q):
            inner, outer = bounds(tree, node, best.unit[q])
            looked += len(q)
            todo += [(int(node[4]), q, np.maximum(least, outer)), (int(node[3]), q, np.maximum(least, inner))]
    return looked


def usable(vector: Column) -> Column:
    """Vectors that take part: neither null, empty nor zero, all components present and finite, and a squared
    norm that a double can hold."""
    norm = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.coalesce((norm > 0) & (norm < float("inf")) & ~F.isnan(norm), F.lit(False))


def _matrix(batch: pa.Table, dims: int) -> np.ndarray:
    column = batch.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)


def _index(keep_ids: int, leaf_rows: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        dims, shard = key[0].as_py(), key[1].as_py()
        tree = build(rows.column("id").to_numpy().astype(np.int64), _matrix(rows, dims), keep_ids, leaf_rows, shard)
        return pa.table({"dims": pa.array([dims], pa.int32()), "shard": [shard], "nodes": [tree.nodes.tobytes()], "vectors": [tree.vectors.tobytes()],
                         "ids": [tree.ids.tobytes()], "id_starts": [tree.id_starts.astype(np.int64).tobytes()]})
    return run


def _block(key: tuple, rows: pa.Table) -> pa.Table:
    dims, block = key[0].as_py(), key[1].as_py()
    return pa.table({"dims": pa.array([dims], pa.int32()), "block": [block], "ids": [rows.column("id").to_numpy().astype(np.int64).tobytes()],
                     "vectors": [_matrix(rows, dims).tobytes()]})


def _visit(k: int, factor: float):
    def result(dims: int, block: int, best: Best) -> pa.RecordBatch:
        place, rank = np.nonzero(np.isfinite(best.score))
        return pa.RecordBatch.from_pydict({"dims": pa.array(np.full(len(place), dims), pa.int32()), "block": pa.array(np.full(len(place), block), pa.int64()),
                                           "place": pa.array(place, pa.int32()), "query_id": pa.array(best.ids[place], pa.int64()),
                                           "vec_id": pa.array(best.row[place, rank], pa.int64()), "score": pa.array(best.score[place, rank], pa.float64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(i)[r] for i, n in enumerate(batch.schema.names)}
                dims, block = row["dims"].as_py(), row["block"].as_py()
                if now != (dims, block):
                    if best is not None:
                        yield result(*now, best)
                    now = (dims, block)
                    best = Best(np.frombuffer(row["q_ids"].as_buffer(), np.int64), np.frombuffer(row["q_vectors"].as_buffer()).reshape(-1, dims), k)
                tree = Tree(np.frombuffer(row["vectors"].as_buffer()).reshape(-1, dims), np.frombuffer(row["nodes"].as_buffer()).reshape(-1, len(NODE_FIELDS)),
                            np.frombuffer(row["ids"].as_buffer(), np.int64), np.frombuffer(row["id_starts"].as_buffer(), np.int64))
                search(tree, best, factor)
        if best is not None:
            yield result(*now, best)
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, task_shards: int = TASK_SHARDS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``is_query`` holds, the ``k`` rows of largest cosine
    (double precision, original vectors), best first, ties to the smaller id; all of them if there are fewer.

    Rows take no part if their id is null or their vector is null, empty, zero or holds null or non-finite components.
    Vectors of different length are never compared. A row with the query's own id is no candidate; rows that repeat
    an id are rows of their own, as queries and as candidates. An empty table gives an empty result. Extra columns are
    ignored. Every usable row is indexed; shards and blocks of queries are written once to the shared folder."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                          F.monotonically_increasing_id().alias("at")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("dims", F.size("vector"))
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("asks").cast("long")).alias("asking"))
    sizes = sizes.select("dims", F.ceil(F.col("rows") / shard_rows).alias("shards"), F.greatest(F.ceil(F.col("asking") / query_rows), F.lit(1)).alias("blocks"))
    sizes = materialize(sizes, "vector-sizes")  # a row per length of vector
    dealt = rows.join(sizes, "dims").withColumns({"shard": F.pmod(F.xxhash64("at"), "shards"), "block": F.pmod(F.xxhash64("at"), "blocks")})
    shards = materialize(dealt.select("dims", "shard", "id", "vector").groupBy("dims", "shard").applyInArrow(_index(k + 1, leaf_rows), SHARD_SCHEMA), "vector-shards")
    blocks = dealt.where("asks").select("dims", "block", "id", "vector").groupBy("dims", "block").applyInArrow(_block, BLOCK_SCHEMA)
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("shards") / task_shards) - 1)).alias("run")
    asking = materialize(blocks, "vector-queries").join(sizes, "dims").select("dims", "block", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), runs)
    runs_of = shards.withColumn("run", F.floor(F.col("shard") / task_shards))
    met = asking.join(runs_of, ["dims", "run"]).select("dims", "block", "q_ids", "q_vectors", "nodes", "vectors", "ids", "id_starts")
    found = met.mapInArrow(_visit(k, factor), FOUND_SCHEMA)
    order = Window.partitionBy("dims", "block", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
