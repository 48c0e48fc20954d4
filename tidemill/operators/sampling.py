"""Sorting, sampling, splitting and resampling.

Randomness is a seeded md5 of a stable key, so a sample is the same rows on any
cluster layout (and in DuckDB). Per-class work uses windows partitioned by class
only where the class count bounds the work; the scalable forms use per-row hash
thresholds that need no window at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.hashing import hash_hex, hash_uniform
from tidemill.operators.joins import null_safe_join
from tidemill.operators.ordered import running_totals

BROADCAST_ROWS_MAX = 100_000


def sort_rows(df: DataFrame, keys: list, ascending: list | None = None) -> DataFrame:
    """L1: multi-key sort with per-key direction (keys may be expressions, e.g. ``abs(c)``)."""
    ascending = ascending or [True] * len(keys)
    cols = [(F.col(k) if isinstance(k, str) else k) for k in keys]
    return df.orderBy(*[c.asc() if a else c.desc() for c, a in zip(cols, ascending)])


def top_n(df: DataFrame, n: int, keys: list, ascending: list | None = None) -> DataFrame:
    """L2: ``head(n)`` after a sort / ``nlargest``: a distributed top-n."""
    return sort_rows(df, keys, ascending).limit(n)


TOP_N_MAX = 100_000


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """L3: exactly ``n`` rows without replacement: the ``n`` smallest seeded hashes.
    Small n: a distributed top-n. Large n: exact hash ranks (``rank_within`` over one
    group), since a top-n merges n rows per partition in one task."""
    if n <= TOP_N_MAX:
        return df.orderBy(hash_hex(key, seed), key).limit(n)
    r = rank_within(df.withColumn("_all", F.lit(0)), "_all", key, seed)
    return r.where(F.col("_rank") <= n).drop("_rank", "_group_n", "_all")


def sample_fraction(df: DataFrame, key, fraction: float, seed: int = 42) -> DataFrame:
    """L3 (fraction form): every row with a seeded hash below ``fraction``; no shuffle."""
    return df.where(hash_uniform(key, seed) < fraction)


def random_split(df: DataFrame, key, test_frac: float = 0.2, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    """L4: unstratified split by seeded hash threshold (row-local, no shuffle)."""
    return df.withColumn(split_col, F.when(hash_uniform(key, seed) < test_frac, "test").otherwise("train"))


def rank_within(df: DataFrame, group_cols, key: str, seed: int = 42, buckets: int | None = None,
                out: str = "_rank", target_rows: int = 1_000_000) -> DataFrame:
    """Exact 1-based rank of each row inside its group in seeded hash order
    (``md5(key|seed)``, then ``key``), without a window over a whole group.

    Rows are cut into fixed hash ranges (the first 32 bits of the md5, so bucket order
    agrees with the md5 string order); per (group, bucket) counts give each bucket's
    offset (a table of groups x buckets rows); the rank inside a bucket is a window over
    about n_group / buckets rows. Unless given, the bucket count grows with the largest
    group so that a bucket holds about ``target_rows`` rows at most (1024 at least)."""
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    if buckets is None:
        largest = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        buckets = int(min(1 << 30, max(1024, 2 * -(-largest // target_rows))))
    b = F.least(F.floor(hash_uniform(key, seed) * buckets).cast("int"), F.lit(buckets - 1))
    tagged = df.withColumn("_b", b).withColumn("_h", hash_hex(key, seed))
    counts = tagged.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*groups, "_b", F.coalesce(F.sum("_nb").over(before), F.lit(0)).alias("_off"),
                         F.sum("_nb").over(Window.partitionBy(*groups)).alias("_group_n"))
    j = null_safe_join(tagged, offs, [*groups, "_b"])  # a null group is a group
    w = Window.partitionBy(*groups, "_b").orderBy("_h", key)
    return j.withColumn(out, F.row_number().over(w) + F.col("_off")).drop("_b", "_h", "_off", "_nb")


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.2, seed: int = 42,
                     split_col: str = "split", exact: bool = True) -> DataFrame:
    """Class ratios preserved. ``exact``: per class the ``round(n_c * frac)`` rows
    with the smallest seeded hash are test (ranked with ``rank_within``, so a huge
    class is spread over many tasks); otherwise a per-row hash threshold."""
    if not exact:
        return random_split(df, key, test_frac, seed, split_col)
    r = rank_within(df, label, key, seed)
    out = r.withColumn(split_col, F.when(F.col("_rank") <= F.round(F.col("_group_n") * F.lit(test_frac)), "test")
                       .otherwise("train"))
    return out.drop("_rank", "_group_n")


def oversample(df: DataFrame, key: str, label: str, minority, target_n: int, seed: int = 42) -> DataFrame:
    """The minority class resampled with replacement to ``target_n`` rows, the
    others unchanged (a null class is one of them). Draw i picks minority row ``pmod(hash(seed, i), m)``; draws are
    generated with ``range`` (distributed) and joined to the indexed minority rows."""
    spark = df.sparkSession
    minor = df.where(F.col(label) == F.lit(minority))
    # exact position of each minority row in a seeded order, by a distributed running count
    tagged = minor.withColumn("_u", hash_uniform(key, seed)).withColumn("_one", F.lit(1))
    m_idx = running_totals(tagged, "_u", ["_one"], tie_cols=[key]).select(
        *minor.columns, (F.col("_one_cum") - 1).cast("bigint").alias("_pos"))
    m = minor.count()
    if m == 0:
        return df
    draw_hash = F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f"|{seed}"))), 1, 8), 16, 10)
    draws = spark.range(target_n).select(F.pmod(draw_hash.cast("bigint"), F.lit(m)).alias("_pos"))
    # the join strategy is AQE's: broadcast only when the measured minority side is small
    resampled = draws.join(m_idx, "_pos").drop("_pos")
    return df.where(~F.col(label).eqNullSafe(F.lit(minority))).unionByName(resampled)


def oversample_target(df: DataFrame, label: str, minority, target: str = "max_class") -> int:
    """Q2: size to resample the minority class to: the largest other class
    (``'max_class'``, default) or all other rows together (``'rest'``, the reference)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).where(~F.col(label).eqNullSafe(F.lit(minority)))
    row = counts.agg(F.max("n").alias("mx"), F.sum("n").alias("rest")).first()
    return int(row["mx"] if target == "max_class" else row["rest"])


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``class_weight='balanced'``: n / (k * n_c) as a weight column. The class
    count table has one row per class (bounded) and is broadcast."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = counts.select(label, (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("_nc"))).alias(out))
    if tot["k"] <= BROADCAST_ROWS_MAX:  # one row per class: bounded by the checked class count
        w = F.broadcast(w)
    return null_safe_join(df, w, label, "left")
