"""Spelling variants by permuterm rotations.

A word with a terminator behind it is written in all its rotations. Two words that differ in one
replaced character share the rotation that starts behind it, up to the character itself; a word with
one character more shares that prefix with the whole rotation of the shorter word. So each word
gives, per position, the prefix that skips the character there, and all its whole rotations; sorted,
equal prefixes stand together, and a scan of each group finds the neighbours of its members.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm._shared import materialize

#: Runs of letters that words are made of, and the capitals that are lowered.
LETTERS = "A-Za-zÀ-ÿ"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MIN_LENGTH = 6
MIN_COUNT = 5
#: How much more frequent a form is than its variant.
RATIO = 5
#: Stands behind a word in its rotations; words hold no such character.
TERMINATOR = "\x00"
#: Different words that a Python worker counts before it hands them on.
COUNTED_WORDS = 200_000


def damaged(word: str, doc_id: str, every: int) -> str:
    """``word`` without one code point where ``every`` divides the checksum of document and word."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, damage_every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the runs of letters of all whole texts, A to Z lowered, with at least ``min_length`` code points and
    ``min_count`` occurrences. With ``damage_every`` each document misspells about one word in so many (see
    ``damaged``) before words are counted; a null id counts there as an empty one. Null texts hold no words."""
    pattern = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def handed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for raw, n in Counter(map(re.Match.group, pattern.finditer(text))).items():
                    word = raw.translate(LOWER)
                    if damage_every:
                        word = damaged(word, doc_id, damage_every)
                        if len(word) < min_length:
                            continue
                    counts[word] += n
                if len(counts) >= COUNTED_WORDS:
                    yield handed(counts)
                    counts = Counter()
        yield handed(counts)

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, word, n, skips, first``: the whole rotations of every word (``skips`` false), and those that begin behind
    a character, up to that character (``skips`` true). ``first``: the skipped character begins a run of equal
    ones, so of the ways to skip it that leave the same word only one is ``first``."""
    at, word = F.col("at"), F.col("word")
    head, tail = F.substring(word, F.lit(1), at), F.substring(word, at + 1, F.length(word))
    here, before = F.substring(word, at + 1, F.lit(1)), F.substring(word, at, F.lit(1))
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    whole = F.struct(F.concat(tail, F.lit(TERMINATOR), head).alias("prefix"), F.lit(False).alias("skips"), F.lit(False).alias("first"))
    skip = F.struct(F.concat(F.substring(word, at + 2, F.length(word)), F.lit(TERMINATOR), head).alias("prefix"), F.lit(True).alias("skips"),
                    ((at == 0) | (here != before)).alias("first"))
    both = F.when(at < F.length(word), F.array(whole, skip)).otherwise(F.array(whole))
    return places.select("word", "n", F.inline(both))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: per word with a neighbour, their number and the most frequent one (ties: the least in
    code-point order). A group holds one word per character at most, and each of its rows sees the rest through window
    sums and the two best rows: no pairs are made."""
    group = Window.partitionBy("prefix")
    ranked = group.orderBy(F.col("n").desc(), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row, whole = F.struct("n", "word"), ~F.col("skips")

    def seen(of: Column, which: int = 1) -> Column:
        return F.nth_value(F.when(of, row), which, ignoreNulls=True).over(ranked)

    shared = rotations(words).withColumn("_rows", F.count(F.lit(1)).over(group)).where("_rows > 1").select(
        "word", "n", "skips", "first", F.sum(F.col("skips").cast("long")).over(group).alias("skipping"),
        F.sum(F.col("first").cast("long")).over(group).alias("firsts"), seen(F.col("skips")).alias("one"), seen(F.col("skips"), 2).alias("two"),
        seen(F.col("first")).alias("longer"), seen(whole).alias("shorter"))
    replaced = F.when(F.col("one.word") == F.col("word"), F.col("two")).otherwise(F.col("one"))
    cut = F.when(F.col("first"), F.col("shorter"))
    key = lambda c: F.when(c.isNotNull(), F.struct((-c["n"]).alias("n"), c["word"].alias("word")))
    found = shared.select(
        "word", F.when(F.col("skips"), F.col("skipping") - 1 + cut.isNotNull().cast("long")).otherwise(F.col("firsts")).alias("near"),
        F.when(F.col("skips"), F.least(key(replaced), key(cut))).otherwise(key(F.col("longer"))).alias("best"))
    best = found.where("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` for a table ``word, form``: follow forms to the last. Each round doubles the step, so rounds grow
    with the logarithm of the longest chain; a form is always more frequent than its word, so there is no cycle."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialize(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                             "spelling-roots")
        if joined.where("moved").limit(1).count() == 0:
            return joined.select("word", "root")
        steps = joined.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table ``word, n`` of different words.

    Two words are near if one inserted, deleted or replaced code point turns one into the other. ``form`` is the near
    word of largest ``n`` (ties: least in code-point order) if that is at least ``ratio`` times the word's own, else
    null; ``root`` follows forms to the last and is the word itself if it has none. Case and accents count as
    differences. Null words and rows with a null count are left out; an empty table gives an empty result."""
    words = materialize(words.where("word IS NOT NULL AND n IS NOT NULL").select("word", "n"), "spelling-words")
    has_form = F.col("best_n") >= ratio * F.col("n")
    judged = materialize(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = last_forms(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
