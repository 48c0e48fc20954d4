"""Decision trees grown level by level in Spark aggregates.

Rows stay where they are; the forest so far (model-sized) travels to them. In a pass every task sends its rows
down the trees to the nodes that are still open, and aggregates give the statistics of all open nodes at once.

* ``fit_tree``: exact splits. Class counts per open node, feature and distinct value are summed up in the order of the
  values; every midpoint between neighbouring values is a candidate. Nodes are split until they are pure or
  their rows are all alike, whatever the depth.
* ``fit_extra_trees``: per node a few features drawn by seeded hash, and for each one threshold, uniform by seeded hash
  between the least and largest value inside the node. One pass finds the ranges, one counts the classes on
  both sides. No bins, no bootstrap. If all drawn features are constant in a node, the next ones are drawn. The rows of a node
  of at most ``LOCAL_ROWS`` travel to one task, which grows all below it by the same draws; what it grew stays a stored table.

Only statistics of open nodes (at most ``PASS_NODES`` of them a pass), the one exact tree and the upper nodes of the others reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ordered import running_totals
from tidemill.session import discard, store

PASS_NODES = 20_000
#: Rows of a node up to which a feature's values are summed up in one window; beyond it in ranges of that many.
WINDOW_ROWS = 1_000_000
#: Nodes of a pass up to which the driver draws features and thresholds itself.
DRAW_LOCAL = 2_000
#: Rows of a randomised node up to which one task grows all below it, and bytes of rows that one job sends to such tasks.
LOCAL_ROWS = 16_384
SENT_BYTES = 1 << 30
GROWN = "slot int, f binary, t binary, l binary, v binary"
#: Has Spark delete a query's shuffle files when the query ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class Tree:
    """Nodes in the order they were made; ``name`` is 1 for the root, ``2 i`` and ``2 i + 1`` below node ``i``."""

    name: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)

    def add(self, name: int, counts: np.ndarray) -> int:
        self.name.append(name)
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.left.append(-1)
        self.right.append(-1)
        self.counts.append(np.asarray(counts, float))
        return len(self.name) - 1

    def split(self, at: int, feature: int, threshold: float, left: np.ndarray) -> tuple[int, int]:
        low = self.add(2 * self.name[at], left)
        high = self.add(2 * self.name[at] + 1, self.counts[at] - left)
        self.feature[at], self.threshold[at], self.left[at], self.right[at] = feature, threshold, low, high
        return low, high

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)

    def depth(self) -> int:
        return max(n.bit_length() for n in self.name) - 1


def leaves(x: np.ndarray, arrays: tuple[np.ndarray, ...]) -> np.ndarray:
    """Leaf of each row: values up to the threshold go left."""
    feature, threshold, left, right = arrays
    at = np.zeros(len(x), np.int64)
    rows = np.flatnonzero(feature[at] >= 0)
    while len(rows):
        node = at[rows]
        at[rows] = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
        rows = rows[feature[at[rows]] >= 0]
    return at


@dataclass
class Forest:
    classes: list[float]
    features: list[str]
    trees: list[Tree]
    passes: int

    def probabilities(self) -> Column:
        """Mean over the trees of the class shares in a row's leaf, as an array in the order of ``classes``."""
        packed = [(t.arrays(), np.array([c / c.sum() for c in t.counts])) for t in self.trees]

        @F.pandas_udf("array<double>")
        def run(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            x = np.vstack([np.asarray(v, float) for v in rows])
            total = sum(shares[leaves(x, arrays)] for arrays, shares in packed)
            return pd.Series(list(total / len(packed)))

        return run(vector(self.features))

    def predict(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        """Class of the largest probability (ties: the smaller class). A table without classes predicts null."""
        if not self.trees or not self.classes:
            return df.withColumns({probability: F.lit(None).cast("array<double>"), prediction: F.lit(None).cast("double")})
        d = df.withColumn(probability, self.probabilities())
        at = F.array_position(probability, F.array_max(probability)).cast("int")
        return d.withColumn(prediction, F.element_at(F.array(*[F.lit(float(c)) for c in self.classes]), at))


def vector(features: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def prepared(train: DataFrame, features: list[str], label: str) -> tuple[DataFrame, str, list[float], np.ndarray]:
    """Stored rows ``x, y`` (class numbers), their path, the classes and their counts. Rows with a null label or a missing
    value are left out."""
    d = train.select(vector(features).alias("x"), F.col(label).cast("double").alias("c")).where("c IS NOT NULL AND forall(x, v -> v IS NOT NULL AND NOT isnan(v))")
    sizes = {r["c"]: r["n"] for r in d.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per class
    classes = sorted(sizes)
    number = F.coalesce(*[F.when(F.col("c") == c, F.lit(i)) for i, c in enumerate(classes)], F.lit(0))
    rows, path = store(d.select("x", number.alias("y")), "tree-rows")
    return rows, path, classes, np.array([sizes[c] for c in classes], float)


# ---- exact splits (M6) --------------------------------------------------------------------

def _slots(tree: Tree, open_: list[int]) -> Column:
    """Number of the open node that a row falls into; null where none."""
    arrays, slot = tree.arrays(), np.full(len(tree.name), -1)
    slot[open_] = np.arange(len(open_))

    @F.pandas_udf("int")
    def run(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="int32")
        return pd.Series(slot[leaves(np.vstack([np.asarray(v, float) for v in rows]), arrays)])

    return run(F.col("x"))


def best_splits(rows: DataFrame, classes: int, largest: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``slot, j, threshold, below``: per open node the split of largest ``sum l_c^2 / l + sum r_c^2 / r`` (the least weighted
    Gini impurity; ties: the first feature, then the smallest threshold) from rows ``slot, x, y``. Thresholds are midpoints of
    neighbouring values. Nodes whose rows are alike in every feature have none."""
    names = [f"c{c}" for c in range(classes)]
    values = rows.select("slot", "y", F.posexplode("x").alias("j", "v"))
    counts = values.groupBy("slot", "j", "v").agg(*[F.sum((F.col("y") == c).cast("long")).alias(n) for c, n in enumerate(names)])
    if largest <= window_rows:
        w = Window.partitionBy("slot", "j").orderBy("v")
        summed = counts.select("*", *[F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{n}_cum") for n in names], F.lead("v").over(w).alias("next"))
    else:
        # ranks within the node and feature, to find the next value across ranges
        ranked = running_totals(counts.withColumn("one", F.lit(1)), "v", [*names, "one"], target_rows=window_rows, group_cols=("slot", "j"))
        after = ranked.select("slot", "j", (F.col("one_cum") - 1).alias("one_cum"), F.col("v").alias("next"))
        summed = ranked.join(after, ["slot", "j", "one_cum"], "left")
    total = counts.groupBy("slot", "j").agg(*[F.sum(n).alias(f"{n}_all") for n in names])
    d = summed.where("next IS NOT NULL").join(total, ["slot", "j"])
    low = [F.col(f"{n}_cum").cast("double") for n in names]
    high = [(F.col(f"{n}_all") - F.col(f"{n}_cum")).cast("double") for n in names]
    add = lambda cs: sum(cs[1:], cs[0])
    score = add([c * c for c in low]) / add(low) + add([c * c for c in high]) / add(high)
    middle = (F.col("v") + F.col("next")) / 2
    threshold = F.when(middle < F.col("next"), middle).otherwise(F.col("v"))
    tried = d.select("slot", F.struct(score.alias("score"), (-F.col("j")).alias("j"), (-threshold).alias("t")).alias("rank"), F.array(*[F.col(f"{n}_cum") for n in names]).alias("below"))
    best = tried.groupBy("slot").agg(F.max_by(F.struct("rank", "below"), "rank").alias("b"))
    return best.select("slot", (-F.col("b.rank.j")).alias("j"), (-F.col("b.rank.t")).alias("threshold"), F.col("b.below").alias("below"))


def fit_tree(train: DataFrame, features: list[str], label: str, max_depth: int | None = None, window_rows: int = WINDOW_ROWS) -> Forest:
    """M6: one Gini tree by exact split search, grown until nodes are pure or alike, or to ``max_depth``."""
    rows, path, classes, sizes = prepared(train, features, label)
    tree, passes = Tree(), 0
    root = tree.add(1, sizes)
    queue = [root] if len(classes) > 1 else []
    while queue:
        open_, queue = queue[:PASS_NODES], queue[PASS_NODES:]
        placed = rows.withColumn("slot", _slots(tree, open_)).where("slot >= 0")
        largest = int(max(tree.counts[n].sum() for n in open_))
        passes += 1
        for r in sorted(best_splits(placed, len(classes), largest, window_rows).collect(), key=lambda r: r["slot"]):
            for child in tree.split(open_[r["slot"]], r["j"], r["threshold"], np.array(r["below"], float)):
                deep = max_depth is not None and tree.name[child].bit_length() > max_depth
                if (tree.counts[child] > 0).sum() > 1 and not deep:
                    queue.append(child)
    discard(rows.sparkSession, path)
    return Forest(classes, list(features), [tree] if classes else [], passes)


# ---- extremely randomised trees (M13) --------------------------------------------------------

def uniform(text: str) -> float:
    """A number in [0, 1) from the first 32 bits of the md5, as in ``functions.hashing``."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0


def drawn(tree: int, node: int, attempt: int, d: int, m: int, seed: int) -> list[int]:
    """The features of one attempt at a node: the next ``m`` in the order of their seeded hashes."""
    begin = f"{tree}|{node}|"
    digest = [hashlib.md5(f"{begin}{j}|{seed}".encode()).digest() for j in range(d)]
    return sorted(range(d), key=digest.__getitem__)[attempt * m:(attempt + 1) * m]


def _draw(nodes: list[tuple[int, int, int]], d: int, m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of ``(tree, node, attempt)`` each (-1 where features have run out) and where their thresholds cut the range."""
    cand, cut = np.full((len(nodes), m), -1), np.zeros((len(nodes), m))
    for s, (t, name, attempt) in enumerate(nodes):
        got = drawn(t, name, attempt, d, m, seed)
        cand[s, :len(got)] = got
        cut[s, :len(got)] = [uniform(f"{t}|{name}|{j}|cut|{seed}") for j in got]
    return cand, cut


def _draw_all(rows: DataFrame, nodes: list[tuple[int, int, int]], d: int, m: int, seed: int, local: int = DRAW_LOCAL) -> tuple[np.ndarray, np.ndarray]:
    """``_draw``, shared out among tasks where there are more than ``local`` nodes (the hashes of every feature take longest)."""
    if len(nodes) <= local:
        return _draw(nodes, d, m, seed)
    t, name, attempt = zip(*nodes)
    asked = pa.table({"s": np.arange(len(nodes)), "t": pa.array(t, pa.int64()), "name": [str(n) for n in name], "attempt": pa.array(attempt, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cand, cut = _draw(list(zip(b.column("t").to_pylist(), map(int, b.column("name").to_pylist()), b.column("attempt").to_pylist())), d, m, seed)
            yield pa.RecordBatch.from_pydict({"s": b.column("s"), "cand": pa.array(list(cand), pa.list_(pa.int64())), "cut": pa.array(list(cut), pa.list_(pa.float64()))})

    got = rows.sparkSession.createDataFrame(asked).mapInArrow(run, "s long, cand array<long>, cut array<double>").toArrow().sort_by("s")
    return tuple(got.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(nodes), m) for c in ("cand", "cut"))


def _send_down(rows: DataFrame, forest: dict[int, tuple], slots: dict[int, np.ndarray], candidates: np.ndarray, thresholds: np.ndarray | None,
               classes: int) -> DataFrame:
    """Without thresholds ``cell, lo, hi``: ranges per open node and candidate; with them ``cell, c, n``: rows of class ``c``
    up to the threshold. A task sends one row per cell at most (and class)."""
    n_slots, m = candidates.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.full((n_slots, m), np.inf), np.full((n_slots, m), -np.inf)
        below = np.zeros((n_slots, m, classes), np.int64) if thresholds is not None else None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column(1).to_numpy()
            for t, arrays in forest.items():
                slot = slots[t][leaves(x, arrays)]
                at = np.flatnonzero(slot >= 0)
                if not len(at):
                    continue
                at = at[np.argsort(slot[at], kind="stable")]  # rows of a node side by side
                s = slot[at]
                first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                own = s[first]
                v = x[at[:, None], candidates[s]]
                if below is None:
                    lo[own] = np.minimum(lo[own], np.minimum.reduceat(v, first, axis=0))
                    hi[own] = np.maximum(hi[own], np.maximum.reduceat(v, first, axis=0))
                else:
                    went = v <= thresholds[s]
                    for c in range(classes):
                        below[own, :, c] += np.add.reduceat(went & (y[at] == c)[:, None], first, axis=0, dtype=np.int64)
        if below is None:
            cell = np.flatnonzero(np.isfinite(lo.ravel()))
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int64()), "lo": lo.ravel()[cell], "hi": hi.ravel()[cell]})
        else:
            cell, c = np.nonzero(below.reshape(-1, classes))
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int64()), "c": pa.array(c, pa.int32()), "n": pa.array(below.reshape(-1, classes)[cell, c], pa.int64())})

    if thresholds is None:
        return rows.mapInArrow(run, "cell long, lo double, hi double").groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return rows.mapInArrow(run, "cell long, c int, n long").groupBy("cell", "c").agg(F.sum("n").alias("n"))


def grow_extra(x: np.ndarray, y: np.ndarray, classes: int, tree: int, name: int, m: int, max_depth: int | None, seed: int) -> tuple[np.ndarray, ...]:
    """Feature (-1: leaf), threshold, left child (the right one follows) and class counts of the nodes below ``name``, grown from
    all of its rows, level by level, as the passes would."""
    n, d = x.shape
    feature, threshold, low, counts = np.full(2 * n, -1, np.int32), np.zeros(2 * n), np.full(2 * n, -1, np.int32), np.zeros((2 * n, classes))
    counts[0] = np.bincount(y, minlength=classes)
    made, order, first = 1, np.arange(n), np.zeros(1, np.int64)
    open_ = [(0, name, 0)]  # place, name, attempt
    while open_:
        place = np.array([p for p, _, _ in open_])
        seg = np.repeat(np.arange(len(place)), np.diff(np.append(first, len(order))))
        cand, cut = _draw([(tree, number, attempt) for _, number, attempt in open_], d, m, seed)
        real = cand >= 0
        cand = np.maximum(cand, 0)
        v = x[order[:, None], cand[seg]]
        lo, hi = np.minimum.reduceat(v, first, axis=0), np.maximum.reduceat(v, first, axis=0)
        whole = counts[place]
        best, thr, left, some = _best_cut(cand, real, cut, lo, hi, whole, lambda t: np.stack(
            [np.add.reduceat((v <= t[seg]) & (y[order] == c)[:, None], first, axis=0, dtype=np.int64) for c in range(classes)], axis=2).astype(float))
        near, far, after = np.full(len(place), -1), np.full(len(place), -1), []
        at = np.arange(len(place))
        took = thr[at, best]
        feature[place[some]], threshold[place[some]] = cand[at, best][some], took[some]
        low[place[some]] = made + 2 * np.arange(some.sum())
        for i in at.tolist():
            _, number, attempt = open_[i]
            if not some[i]:
                if (attempt + 1) * m < d:
                    near[i] = far[i] = len(after)
                    after.append((int(place[i]), number, attempt + 1))
                continue
            counts[made], counts[made + 1] = left[i], whole[i] - left[i]
            for side, child, child_name in ((near, made, 2 * number), (far, made + 1, 2 * number + 1)):
                if (counts[child] > 0).sum() > 1 and (max_depth is None or child_name.bit_length() <= max_depth):
                    side[i] = len(after)
                    after.append((child, child_name, 0))
            made += 2
        goes = np.where(v[np.arange(len(order)), best[seg]] <= took[seg], near[seg], far[seg])
        kept = np.flatnonzero(goes >= 0)
        by = np.argsort(goes[kept], kind="stable")
        order, goes = order[kept][by], goes[kept][by]
        first = np.flatnonzero(np.concatenate([[True], goes[1:] != goes[:-1]])) if len(goes) else np.zeros(0, np.int64)
        open_ = after
    return feature[:made], threshold[:made], low[:made], counts[:made]


def _best_cut(cand, real, cut, lo, hi, whole, count) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the best of its candidates, the thresholds of all, the classes up to the best one, and whether any candidate varies.
    ``count`` gives the classes up to each threshold."""
    real = real & (lo < hi)
    thr = lo + cut * (hi - lo)
    thr = np.where(thr >= hi, lo, thr)
    below = count(thr)
    high = whole[:, None, :] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (below ** 2).sum(axis=2) / below.sum(axis=2) + (high ** 2).sum(axis=2) / high.sum(axis=2)
    best = np.where(real, score, -np.inf).argmax(axis=1)
    return best, thr, below[np.arange(len(best)), best], real.any(axis=1)


def bytes_column(values: np.ndarray) -> pa.Array:
    """A binary value per row of a matrix."""
    n, width = len(values), values.shape[1] * values.itemsize
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * width + 1, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)),
                                                  pa.py_buffer(np.ascontiguousarray(values))])


def bytes_matrix(column: pa.ChunkedArray, kind: str, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), d).astype(float)


@contextmanager
def short_lived_shuffles(spark):
    """Shuffle files of a stored step are deleted at its end: nothing reads them again."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)


def _to_slots(rows: DataFrame, carried: str, forest: dict[int, tuple], slots: dict[int, np.ndarray], kind: str) -> DataFrame:
    """``slot, carried, b``: per tree the rows ``x`` that fall into a node with a slot; ``carried`` is a column and its type."""
    name = carried.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            b = bytes_column(x.astype(kind))
            for t, arrays in forest.items():
                slot = slots[t][leaves(x, arrays)]
                at = pa.array(np.flatnonzero(slot >= 0))
                if len(at):
                    yield pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int32()).take(at), name: batch.column(name).take(at), "b": b.take(at)})

    return rows.select(name, "x").mapInArrow(run, f"slot int, {carried}, b binary")


@dataclass
class DealtForest:
    """``tops``: the upper nodes of each tree; ``slots``: per tree the slot of a node (-1 above the last ones); ``grown``: what lies below a
    slot, a stored table. ``kind``: number type that holds the values exactly."""

    classes: list[float]
    features: list[str]
    tops: list[Tree]
    slots: list[np.ndarray]
    grown: DataFrame | None
    rows: int
    passes: int
    kind: str

    @property
    def trees(self) -> list[Tree]:
        """Whole trees, gathered on the driver: for small ones."""
        out = [Tree(*[list(v) for v in (t.name, t.feature, t.threshold, t.left, t.right, t.counts)]) for t in self.tops]
        below = {r["slot"]: r for r in self.grown.collect()} if out else {}
        for tree, own in zip(out, self.slots):
            for place in np.flatnonzero(own >= 0).tolist():
                r = below[own[place]]
                f, t, l, v = _unpacked(*(r[c] for c in "ftlv"))
                v, at = v.reshape(len(f), -1), {0: place}
                for i in range(len(f)):  # a child stands behind its parent
                    if f[i] >= 0:
                        at[int(l[i])], at[int(l[i]) + 1] = tree.split(at[i], int(f[i]), float(t[i]), v[l[i]])
        return out

    def predict(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        """Mean over the trees of the class shares in a row's leaf, in the order of ``classes``, and the class of the largest (ties: the smaller
        class). A table without classes predicts null. Rows travel to the grown parts."""
        if not self.tops or not self.classes:
            return df.withColumns({probability: F.lit(None).cast("array<double>"), prediction: F.lit(None).cast("double")})
        spark = df.sparkSession
        held, _ = store(df.withColumn("_row", F.monotonically_increasing_id()), "scored-rows")
        asked, n = held.select("_row", vector(self.features).alias("x")), held.count()
        d, kind, parts = len(self.features), self.kind, max(1, math.ceil(n / max(self.rows, 1)))
        if kind == "f4" and asked.where(~_single("x")).limit(1).count():
            kind = "f8"
        tasks = 4 * spark.sparkContext.defaultParallelism
        owner = np.empty(sum(int((s >= 0).sum()) for s in self.slots), np.int64)
        for t, s in enumerate(self.slots):
            owner[s[s >= 0]] = t

        def answer(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"_row": pa.array([], pa.int64()), "tree": pa.array([], pa.int32()), "shares": pa.array([], pa.list_(pa.float64()))})
            f, t, l, v = _unpacked(*(right.column(c)[0].as_py() for c in "ftlv"))
            counts = v.reshape(len(f), -1)[leaves(bytes_matrix(left.column("b"), kind, d), (f, t, l, l + 1))]
            tree = pa.array(np.full(left.num_rows, owner[left.column("slot")[0].as_py()]), pa.int32())
            return pa.table({"_row": left.column("_row"), "tree": tree, "shares": pa.array(list(counts / counts.sum(axis=1, keepdims=True)), pa.list_(pa.float64()))})

        votes, step = [], max(1, SENT_BYTES // max(1, n * d * int(kind[1])))
        for low in range(0, len(self.tops), step):
            mine = range(low, min(low + step, len(self.tops)))
            sent = _to_slots(asked, "_row long", {t: self.tops[t].arrays() for t in mine}, {t: self.slots[t] for t in mine}, kind)
            sent = sent.withColumn("part", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int"))
            used = np.concatenate([self.slots[t][self.slots[t] >= 0] for t in mine])
            below = self.grown.where(F.col("slot").between(int(used.min()), int(used.max()))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            met = sent.repartition(tasks, "slot", "part").groupBy("slot", "part").cogroup(below.repartition(tasks, "slot", "part").groupBy("slot", "part"))
            with short_lived_shuffles(spark):
                votes.append(store(met.applyInArrow(answer, "_row long, tree int, shares array<double>"), "tree-votes")[0])
        every = votes[0]
        for more in votes[1:]:
            every = every.unionAll(more)
        # in the order of the trees, so sums are the same in every run
        listed = every.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("tree", "shares"))).alias("v"))
        add = lambda c: lambda a, s: a + F.get(s["shares"], c)
        total = F.array(*[F.aggregate("v", F.lit(0.0), add(c)) / F.lit(float(len(self.tops))) for c in range(len(self.classes))])
        p = held.join(listed.select("_row", total.alias(probability)), "_row", "left").drop("_row")
        at = F.array_position(probability, F.array_max(probability)).cast("int")
        return p.withColumn(prediction, F.element_at(F.array(*[F.lit(float(c)) for c in self.classes]), at))


def _unpacked(f: bytes, t: bytes, l: bytes, v: bytes) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(b, kind) for b, kind in ((f, np.int32), (t, np.float64), (l, np.int32), (v, np.float64)))


def _single(x: str) -> Column:
    """Whether all values are the same as numbers of single precision."""
    return F.forall(x, lambda v: v.isNull() | F.isnan(v) | (v == v.cast("float").cast("double")))


def fit_extra_trees(train: DataFrame, features: list[str], label: str, trees: int = 100, candidates: int | None = None, seed: int = 42,
                    max_depth: int | None = None, pass_nodes: int = PASS_NODES, local_rows: int = LOCAL_ROWS) -> DealtForest:
    """Extremely randomised trees without bootstrap, ``candidates`` features a node (default: the root of their number),
    grown until nodes are pure or alike, or to ``max_depth``. The same trees in every run, whatever ``local_rows``."""
    rows, path, classes, sizes = prepared(train, features, label)
    spark, d, k, n = rows.sparkSession, len(features), len(classes), int(sizes.sum())
    m = min(d, candidates or max(1, int(math.sqrt(d))))
    tops = [Tree() for _ in range(trees)] if classes else []
    queue, small, passes = [], set(), 0

    def open_up(t: int, node: int) -> None:
        if tops[t].counts[node].sum() > local_rows:
            queue.append((t, node, 0))
        else:
            small.add((t, node))

    for t, tree in enumerate(tops):
        root = tree.add(1, sizes)
        if k > 1:
            open_up(t, root)
    while queue:
        now, queue[:pass_nodes] = queue[:pass_nodes], []
        passes += 1
        used = sorted({t for t, _, _ in now})
        arrays = {t: tops[t].arrays() for t in used}
        slots = {t: np.full(len(tops[t].name), -1) for t in used}
        for s, (t, node, _) in enumerate(now):
            slots[t][node] = s
        cand, cut = _draw_all(rows, [(t, tops[t].name[node], attempt) for t, node, attempt in now], d, m, seed)
        real = cand >= 0
        cand = np.maximum(cand, 0)
        ranges = _send_down(rows, arrays, slots, cand, None, k).toArrow()
        lo, hi = np.zeros(cand.size), np.zeros(cand.size)
        cell = ranges.column("cell").to_numpy()
        lo[cell], hi[cell] = ranges.column("lo").to_numpy(), ranges.column("hi").to_numpy()

        def count(thr: np.ndarray, arrays=arrays, slots=slots, cand=cand) -> np.ndarray:
            counted = _send_down(rows, arrays, slots, cand, thr, k).toArrow()
            below = np.zeros((cand.size, k))
            below[counted.column("cell").to_numpy(), counted.column("c").to_numpy()] = counted.column("n").to_numpy()
            return below.reshape(*cand.shape, k)

        whole = np.array([tops[t].counts[node] for t, node, _ in now])
        best, thr, left, some = _best_cut(cand, real, cut, lo.reshape(cand.shape), hi.reshape(cand.shape), whole, count)
        mixed = np.stack([(left > 0).sum(axis=1) > 1, (whole - left > 0).sum(axis=1) > 1], axis=1)
        for s, (t, node, attempt) in enumerate(now):
            tree = tops[t]
            if not some[s]:
                if (attempt + 1) * m < d:
                    queue.append((t, node, attempt + 1))
                continue
            b = int(best[s])
            for child, more in zip(tree.split(node, int(cand[s, b]), float(thr[s, b]), left[s]), mixed[s].tolist()):
                if more and (max_depth is None or tree.name[child].bit_length() <= max_depth):
                    open_up(t, child)
    if not tops:
        discard(spark, path)
        return DealtForest(classes, list(features), [], [], None, 0, passes, "f8")

    # what lies below the others
    own, wanted, owner, names, ended = [], [], [], [], []
    for t, tree in enumerate(tops):
        slot, grows = np.full(len(tree.name), -1), np.full(len(tree.name), -1)
        for place, feature in enumerate(tree.feature):
            if feature < 0:
                slot[place] = len(owner)
                if (t, place) in small:
                    grows[place] = len(owner)
                else:
                    ended.append((len(owner), tree.counts[place]))
                owner.append(t)
                names.append(tree.name[place])
        own.append(slot)
        wanted.append(grows)
    kind = "f8" if rows.where(~_single("x")).limit(1).count() else "f4"

    def grow(table: pa.Table) -> pa.Table:
        s = table.column("slot")[0].as_py()
        grown = grow_extra(bytes_matrix(table.column("b"), kind, d), table.column("y").to_numpy(), k, owner[s], names[s], m, max_depth, seed)
        return pa.table({"slot": pa.array([s], pa.int32()), **{c: pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for c, a in zip("ftlv", grown)}})

    step, parts, tasks = max(1, SENT_BYTES // max(1, n * d * int(kind[1]))), [], 4 * spark.sparkContext.defaultParallelism
    for low in range(0, trees, step):
        mine = [t for t in range(low, min(low + step, trees)) if (wanted[t] >= 0).any()]
        if mine:
            sent = _to_slots(rows, "y int", {t: tops[t].arrays() for t in mine}, {t: wanted[t] for t in mine}, kind)
            with short_lived_shuffles(spark):
                parts.append(store(sent.repartition(tasks, "slot").groupBy("slot").applyInArrow(grow, GROWN), "trees-grown")[0])
    flat = [(s, *(bytearray(a.tobytes()) for a in (np.array([-1], np.int32), np.zeros(1), np.array([-1], np.int32), np.asarray(v, float)))) for s, v in ended]
    if flat:
        parts.append(spark.createDataFrame(flat, GROWN))
    grown = parts[0]
    for more in parts[1:]:
        grown = grown.unionAll(more)
    discard(spark, path)
    return DealtForest(classes, list(features), tops, own, grown, n, passes, kind)


def split_table(forest: Forest | DealtForest, levels: int) -> list[tuple[int, int, str, float, int, int]]:
    """``(tree, node, feature, threshold, rows left, rows right)`` of the splits in the first levels."""
    return [(t, tree.name[i], forest.features[tree.feature[i]], tree.threshold[i], int(tree.counts[tree.left[i]].sum()), int(tree.counts[tree.right[i]].sum()))
            for t, tree in enumerate(forest.trees) for i in range(len(tree.name)) if tree.feature[i] >= 0 and tree.name[i].bit_length() <= levels]
