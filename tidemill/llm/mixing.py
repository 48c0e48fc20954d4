"""Mixing sources to target weights by a low-discrepancy schedule.

Golden-ratio points ``frac(k * 0.618...)`` are mapped through the cumulative target shares
to a source per slot; slots are ranked within their source; the i-th slot of a source
takes the i-th block of equally many words of the source's shuffled stream. A stream passes over
the source again (at most ``max_epochs`` times) when its target exceeds its size.
DataFrame operations only.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm._shared import SPACE, materialize, with_row_id, word_count

BLOCK_WORDS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
#: Rows that one task ranks at a time.
RUN_ROWS = 50_000
#: Cells of the unit interval over which slots look up their source.
CELLS = 16_384
#: Slots of one step of the split product below.
STEP = 1 << 20


def _golden_point(k: Column) -> Column:
    """frac(k / golden ratio), k split in two so that doubles keep the fraction exact enough."""
    getcontext().prec = 60
    g = (Decimal(5).sqrt() - 1) / 2
    low, high = float(g), float((g * STEP) % 1)
    x = F.floor(k / F.lit(STEP)) * F.lit(high) + (k % F.lit(STEP)) * F.lit(low)
    return x - F.floor(x)


def source_key(source: Column) -> Column:
    """A non-null key that sorts as the source by code point, null last."""
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source))


def running(df: DataFrame, keys: list[str], run: str, order: list, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same ``keys``, in the order of ``run`` and
    then ``order``: a window inside each bounded run plus the sums of the runs before it, so a
    hot key is spread over its runs."""
    w = Window.partitionBy(*keys, run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))
    before = Window.partitionBy(*keys).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(*keys, run).agg(F.sum(value).alias("_s"))
               .select(*keys, run, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before")))
    return inner.join(offsets, [*keys, run]).withColumn(out, (F.col(out) + F.col("_before")).cast("long")).drop("_before")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets per source from ``(_src, size)`` rows: ``_src, source_size, target``.

    Sources in code-point order (null last) weigh ``weights``, repeating; together they take
    all words. A target stops at ``max_epochs`` times its source's size; the excess is shared
    again by weight among the others until no target is above. Only sums reach the driver.
    """
    per = sizes.groupBy("_src").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(Window.orderBy("_src")) - 1) % len(weights) + 1)
    # one row per source: the window orders source names only, never documents
    per = materialize(per.withColumn("_w", w), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * float(max_epochs)
    level = None
    while True:
        open_ = F.lit(True) if level is None else cap >= F.col("_w") * F.lit(level)
        r = per.agg(F.sum(F.when(open_, F.col("_w"))).alias("w"), F.sum(F.when(~open_, cap)).alias("c")).first()
        share = float((total - (r["c"] or 0.0)) / r["w"]) if r["w"] else (level or 0.0)
        if level is not None and share <= level:
            break
        level = share
    return per.select("_src", "source_size", F.least(cap, F.col("_w") * F.lit(level)).cast("double").alias("target"))


def _schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """``_src, _block, slot``: when each block of each source is due. Every source gets exactly
    the blocks its target needs: surplus slots fall away, missing ones follow at the end."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    n = int(total // block_words) + 1
    cum = sources.withColumn("_hi", F.sum("target").over(Window.orderBy("_src"))).withColumn("_lo", F.col("_hi") - F.col("target"))
    share = cum.where("target > 0").select("_src", (F.col("_lo") / F.lit(total or 1.0)).alias("_lo"), (F.col("_hi") / F.lit(total or 1.0)).alias("_hi"))
    share = share.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_lo") * CELLS), F.least(F.floor(F.col("_hi") * CELLS), F.lit(CELLS - 1)))))
    slots = spark.range(n).withColumn("_u", _golden_point(F.col("id"))).withColumn("_cell", F.floor(F.col("_u") * CELLS))
    placed = slots.join(share, "_cell").where("_u >= _lo AND _u < _hi").select("_src", F.col("id").alias("slot"), F.floor(F.col("id") / F.lit(RUN_ROWS)).alias("_run"))
    ranked = running(placed, ["_src"], "_run", ["slot"], F.lit(1), "_block").select("_src", "_block", "slot")
    need = sources.where("target > 0").withColumn("_blocks", F.ceil(F.round("target") / F.lit(block_words)))
    wanted = need.where("_blocks > 0").select("_src", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block"))
    return wanted.join(ranked, ["_src", "_block"], "left").withColumn("slot", F.coalesce("slot", F.lit(n) + F.col("_block")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS,
        seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Plan a mix. Returns ``(rows, takes)``, both stored tables.

    ``rows``: one per input row: ``_rid, id_col, source_col, size, source_size, target``.
    ``takes``: ``_rid, epoch, slot, first, words``: in ``slot`` the mix takes ``words`` words from
    word ``first`` of that row, in that pass over its source.

    Null text has size 0 and is never taken; null sources form one source, sorted last; repeated
    rows are separate rows; the shuffle orders rows by a hash of id and text, ties by row number. Every source
    gives ``round(target)`` words and no row more than ``max_epochs`` times its size.
    ``docs`` must be a stored table. Texts are read once and not shuffled; a hot source is
    cut into runs of bounded size.
    """
    base = with_row_id(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(text_col).alias("_text")))
    base = base.select("_rid", "_id", "_source", source_key(F.col("_source").cast("string")).alias("_src"), word_count(F.col("_text")).alias("size"),
                       F.xxhash64(F.lit(seed), F.col("_id").cast("string"), F.col("_text")).alias("_h"))
    base = materialize(base, "mix-sizes")
    n_runs = int(base.count() // RUN_ROWS) + 1
    sources = materialize(source_targets(base.select("_src", "size"), weights, max_epochs), "mix-targets")
    shuffled = base.withColumn("_run", F.pmod(F.shiftright("_h", 20), F.lit(n_runs)))
    placed = running(shuffled, ["_src"], "_run", ["_h", "_rid"], F.col("size"), "_start").join(sources, "_src")
    placed = materialize(placed.select("_rid", "_id", "_source", "_src", "size", "source_size", "target", "_start"), "mix-streams")
    quota = F.round("target").cast("long")
    spans = (placed.where("size > 0")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
             .withColumn("_a", F.col("_start") + F.col("epoch") * F.col("source_size"))
             .withColumn("_b", F.least(F.col("_a") + F.col("size"), quota)).where("_b > _a")
             .withColumn("_block", F.explode(F.sequence(F.floor(F.col("_a") / block_words), F.floor((F.col("_b") - 1) / block_words)))))
    lo = F.greatest("_a", F.col("_block") * block_words)
    hi = F.least("_b", (F.col("_block") + 1) * block_words)
    takes = (spans.join(_schedule(sources, block_words), ["_src", "_block"])
             .select("_rid", "epoch", "slot", (lo - F.col("_a")).alias("first"), (hi - lo).alias("words")))
    rows = placed.select("_rid", F.col("_id").alias(id_col), F.col("_source").alias(source_col), "size", "source_size", "target")
    return rows, materialize(takes, "mix-takes")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: one row per document and pass over its
    source, the text cut to the words taken (whole when all are; then byte for byte)."""
    text = options.get("text_col", "text")
    _, takes = mix(docs, **options)
    per = takes.groupBy("_rid", "epoch").agg(F.sum("words").alias("_n"), F.min("first").alias("_first"))
    joined = with_row_id(docs).join(per, "_rid")
    words = F.filter(F.split(F.col(text), f"[{SPACE}]+"), lambda x: x != "")
    part = F.array_join(F.slice(words, (F.col("_first") + 1).cast("int"), F.col("_n").cast("int")), " ")
    cut = F.when(F.col("_n") == word_count(F.col(text)), F.col(text)).otherwise(part)
    return joined.withColumn(text, cut).select(*docs.columns)
