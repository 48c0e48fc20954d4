"""Near-duplicate documents by improved consistent weighted sampling (Ioffe 2010).

A document is the weighted set of its five-word shingles, weight = count x inverse document
frequency, which is counted for every shingle. Consistent samples agree between two documents with the probability of their weighted
Jaccard similarity; bands of samples propose candidates and the similarity of the whole sets
verifies them. Classes are the connected components of the verified links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.llm._shared import drop, map_texts, materialize, with_row_id
from tidemill.llm._text import mix, run_hashes, split_words, worker_cache
from tidemill.llm.graph import components

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
BANDS, ROWS = 12, 4
#: Share of agreeing samples below which a pair of a mixed bucket is not worth an exact comparison: for a
#: pair of similarity 0.8 and 48 samples, fewer than half agree about once in a million pairs.
MIN_AGREEMENT = 0.5
#: Bucket members that one side of a task compares, and bytes of sets that one call is handed.
CHUNK, GROUP_BYTES = 512, 16_000_000
#: Bucket rows of one smallest class that are kept together.
FAMILY_ROWS = 4096
#: Characters of texts that a Python worker handles at a time.
TEXT_CHARS = 1_000_000
#: Shingles that a task counts at a time, about.
SLOT_SHINGLES = 2_000_000
#: Share of the documents up to which a shingle counts as rare. The counts of rare shingles travel to the rows that hold them; the
#: few common ones, whose number is bounded whatever the corpus holds, are handed to every task. Both are exact.
RARE_SHARE = 0.01
#: Candidates for common shingles that the driver hands to every task; more are joined to the counts instead.
HANDED_SHINGLES = 100_000


def all_shingles(texts: list[str], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """``(text, shingle)`` of every shingle, in text order. Words are runs of letters and digits in lower
    case; a text of fewer words is one shingle."""
    w = split_words(texts, "isalnum")
    if not len(w.begin):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = run_hashes(w.cp, w.begin, w.stop)
    n = np.bincount(w.text, minlength=len(texts))
    end = np.cumsum(n)
    begin = np.arange(len(word))
    start = np.flatnonzero((begin + words <= end[w.text]) | (begin == (end - n)[w.text]))
    who = w.text[start]
    return who, run_hashes(word, start, np.minimum(start + words, end[who]))


def shingles(texts: list[str], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, shingle, count)`` of the different shingles, by text, then shingle."""
    who, key = all_shingles(texts, words)
    order = np.argsort(key)
    small = who.astype(np.uint16) if len(texts) <= 1 << 16 else who
    order = order[np.argsort(small[order], kind="stable")]
    who, key = who[order], key[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
    at = np.flatnonzero(first)
    return who[at], key[at], np.diff(np.append(at, len(key)))


def document_counts(who: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles and the number of texts with each."""
    order = np.lexsort((who, key))
    who, key = who[order], key[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
    return np.unique(key[first], return_counts=True)


def looked_up(key: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys are among the sorted known ones, and their places there."""
    at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
    hit = known[at] == key if len(known) else np.zeros(len(key), bool)
    return hit, at[hit]


class Weights:
    """Inverse document frequencies ``log1p(documents / (count + 1))``, as if one more document held every shingle.

    Common shingles' counts are held here; those of other shingles come as sorted ``known`` keys and their ``counts``, and a
    shingle that has neither stands in one document."""

    def __init__(self, common: np.ndarray, counts: np.ndarray, documents: int):
        order = np.argsort(common)
        self.common, self.counts, self.documents = common[order], counts[order].astype(np.int64), documents

    def documents_of(self, key: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.ones(len(key), np.int64)
        for keys, n in ((known, counts), (self.common, self.counts)):
            hit, at = looked_up(key, keys)
            out[hit] = n[at]
        return out

    def __call__(self, count: np.ndarray, documents: np.ndarray) -> np.ndarray:
        return np.log1p(self.documents / (documents + 1.0)) * count


def packed_counts(n: np.ndarray) -> bytes:
    """Counts in as many bytes each as the largest needs."""
    small = n.astype(np.min_scalar_type(int(n.max())))
    return bytes([small.itemsize]) + small.tobytes()


def unpacked_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", offset=1).astype(np.int64)


def draws() -> tuple[np.ndarray, np.ndarray]:
    """Gamma(2, 1) variates and their logarithms, looked up by 16 bits of a hash."""
    cache = worker_cache()
    if "gamma" not in cache:
        rng = np.random.default_rng(5)
        u = (np.arange(1 << 16) + 0.5) / (1 << 16)
        g = -np.log(u * rng.permutation(u))
        cache["gamma"] = g.astype(np.float32), np.log(rng.permutation(g)).astype(np.float32)
    return cache["gamma"]


def band_keys(who: np.ndarray, key: np.ndarray, weight: np.ndarray, texts: int, bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts that have shingles, and for each its band keys and its samples (32 bits of each).

    A shingle of weight w draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash; with t = floor(ln w / r + b)
    the text's sample is the (shingle, t) of least ln c - r (t - b + 1)."""
    gamma, log_gamma = draws()
    at = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.empty(0, np.int64)
    size = np.diff(np.append(at, len(who)))
    log_w = np.log(weight).astype(np.float32)
    out, samples = np.empty((len(at), bands), np.int64), np.empty((len(at), bands * rows), np.uint32)
    low = np.uint64(0xFFFF)
    for band in range(bands):
        total = np.full(len(at), band + 1, np.uint64)
        for row in range(rows):
            h = mix(key + np.uint64(0x632BE59BD9B4E019 * (band * rows + row + 1) % (1 << 64)))
            r = gamma[(h >> np.uint64(48)).astype(np.int64)]
            b = ((h >> np.uint64(16)) & low).astype(np.float32) * np.float32(1 / 65536)
            t = np.floor(log_w / r + b)
            a = log_gamma[((h >> np.uint64(32)) & low).astype(np.int64)] - r * (t - b + 1)
            least = np.minimum.reduceat(a, at) if len(at) else a
            hit = np.flatnonzero(a == np.repeat(least, size))
            pick = hit[np.searchsorted(hit, at)]
            sample = key[pick] + t[pick].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            samples[:, band * rows + row] = mix(sample) >> np.uint64(32)
            total = mix(total * np.uint64(31) + sample)
        out[:, band] = total.view(np.int64)
    return who[at], out, samples


def _mixed_links(members: DataFrame, signed: DataFrame, sets: DataFrame, roots: DataFrame, min_agreement: float, min_similarity: float) -> DataFrame:
    """``a, b``: links between classes, from buckets whose members are not all of one class.

    All pairs of different classes that agree in enough samples are compared by their whole sets,
    in the first bucket they share, inside one task: best agreement first, and not at all once the task
    has linked them. Only links leave a task. A larger bucket is cut into chunks, each pair of chunks in one task.
    Buckets of the same smallest class meet in the same task, up to ``FAMILY_ROWS`` of their rows, so that a document's
    set travels about once and not once per band; beyond that they are dealt out by bucket."""
    placed = members.select("_band", "_key", "_rid").join(roots.withColumnRenamed("node", "_rid"), "_rid", "left").withColumn("_root", F.coalesce("root", "_rid"))
    open_ = placed.groupBy("_band", "_key").agg(F.min("_root").alias("_lo"), F.max("_root").alias("hi"), F.count(F.lit(1)).alias("_n")).where("_lo <> hi").drop("hi")
    family = open_.groupBy("_lo").agg(F.ceil(F.sum("_n") / FAMILY_ROWS).alias("_parts"))
    open_ = open_.join(family, "_lo").withColumn("_part", F.pmod(F.xxhash64("_band", "_key"), "_parts")).drop("_parts")
    rows = materialize(placed.join(open_, ["_band", "_key"]).drop("root"), "mixed-buckets")
    chunks = F.ceil(F.col("_n") / CHUNK)
    cut_up = rows.withColumn("_c", F.pmod(F.xxhash64("_rid"), chunks)).withColumn("_d", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    data = signed.select("_rid", "_samples", "_bands").join(sets, "_rid")
    sizes = sets.select("_rid", (F.length("k") + F.length("w")).alias("_size"))
    total = rows.join(sizes, "_rid").agg(F.sum("_size")).first()[0] or 0
    groups = F.lit(int(total // GROUP_BYTES) + 1)
    cut_up = cut_up.select("_band", "_key", F.least("_c", "_d").alias("_i"), F.greatest("_c", "_d").alias("_j"), "_c", "_rid", "_root", "_lo", "_part")
    cut_up = cut_up.withColumn("_g", F.pmod(F.xxhash64("_lo", "_part", "_i", "_j"), groups)).drop("_lo", "_part")
    needed = cut_up.select(F.col("_g").alias("_task"), F.col("_rid").alias("_doc")).distinct().join(data.withColumnRenamed("_rid", "_doc"), "_doc")

    def compare(frame: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        """Links of every (bucket, chunk, chunk) in the frame."""
        frame = frame.sort_values(["_band", "_key", "_i", "_j"], kind="stable", ignore_index=True)
        where = frame[["_band", "_key", "_i", "_j"]].to_numpy()
        cut = np.concatenate([[0], np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1, [len(where)]])
        rid, root, part, band = (frame[c].to_numpy() for c in ("_rid", "_root", "_c", "_band"))
        data = data.sort_values("_doc", ignore_index=True)
        of = np.searchsorted(data["_doc"].to_numpy(), rid)
        samples = np.stack([np.frombuffer(v, np.uint32) for v in data["_samples"]])[of]
        bands = np.stack(data["_bands"].to_list())[of]
        ks, ws = data["k"].to_numpy()[of], data["w"].to_numpy()[of]
        least = max(1, math.ceil(min_agreement * samples.shape[1]))
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        links = []
        for lo, hi in zip(cut, cut[1:]):
            at = np.arange(lo, hi)
            left, right = at[part[lo:hi] == where[lo, 2]], at[part[lo:hi] == where[lo, 3]]
            if not len(left) or not len(right):
                continue
            agree = np.zeros((len(left), len(right)), np.uint16)
            for k in range(samples.shape[1]):
                agree += samples[left, k][:, None] == samples[right, k][None, :]
            agree[root[left][:, None] == root[right][None, :]] = 0
            if where[lo, 2] == where[lo, 3]:
                agree = np.triu(agree, 1)
            for e in range(band[lo]):  # compared in an earlier band
                agree[bands[left, e][:, None] == bands[right, e][None, :]] = 0
            i, j = np.nonzero(agree >= least)
            order = np.argsort(-agree[i, j].astype(np.int32), kind="stable")
            for x, y in zip(left[i[order]].tolist(), right[j[order]].tolist()):
                a, b = top(root[x]), top(root[y])
                if a != b and similarity(np.frombuffer(ks[x], np.uint64), np.frombuffer(ws[x]), np.frombuffer(ks[y], np.uint64), np.frombuffer(ws[y])) >= min_similarity:
                    up[max(a, b)] = min(a, b)
                    links.append((rid[x], rid[y]))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    found = materialize(cut_up.groupBy("_g").cogroup(needed.groupBy("_task")).applyInPandas(compare, "a long, b long"), "mixed-links")
    drop(rows)
    return found


def common_shingles(docs: DataFrame, text_col: str, rare_share: float) -> tuple[np.ndarray, np.ndarray, int, float]:
    """Arguments of ``Weights``, and the share: exact document counts of all shingles in more than ``rare_share`` of the documents. (Those of
    all others: ``rare_counts``.)

    A shingle common overall is common in some run of documents (pigeonhole), so runs report their
    own common ones with counts; sums plus what silent runs may hide bound every count from above,
    and only shingles whose bound reaches the share are then counted over all documents. Where runs hold hundreds of
    documents these are at most a few times (shingles per document / ``rare_share``); short runs hide more, and
    then the candidates stay in Spark and meet the counts of all shingles in a join. Only the common ones, which are
    at most (shingles per document / ``rare_share``), reach the driver."""
    half = rare_share / 2

    def report_work():
        def run(texts: list[str]):
            who, key = all_shingles(texts)
            hidden = max(1.0, half * len(texts))
            keys, n = np.unique(key, return_counts=True)
            often = np.isin(key, keys[n > hidden])  # occurrences first: few shingles are left to count by text
            keys, n = document_counts(who[often], key[often])
            loud = n > hidden
            return [0] * (int(loud.sum()) + 1), [[None, *keys[loud].view(np.int64).tolist()], [float(len(texts)), *(n[loud] - hidden).tolist()], [hidden] + [0.0] * int(loud.sum())]
        return run

    runs = map_texts(docs, {}, F.col(text_col), "k bigint, n double, hidden double", report_work, 2 * TEXT_CHARS)
    sums = materialize(runs.groupBy("k").agg(F.sum("n").alias("n"), F.sum("hidden").alias("hidden")), "shingle-runs")
    whole = sums.where("k IS NULL").first()
    if whole is None:
        return np.empty(0, np.uint64), np.empty(0), 0, rare_share
    documents = int(whole["n"])
    loud = sums.where(F.col("k").isNotNull() & (F.col("n") + F.lit(whole["hidden"]) >= rare_share * documents))
    loud = loud.select("k")
    few = loud.limit(HANDED_SHINGLES + 1).count() <= HANDED_SHINGLES
    wanted = np.sort(np.array([r["k"] for r in loud.collect()] if few else [], np.int64).view(np.uint64))

    def count_work():
        def run(texts: list[str]):
            who, key = all_shingles(texts)
            if few:
                at = np.minimum(np.searchsorted(wanted, key), max(len(wanted) - 1, 0))
                hit = wanted[at] == key if len(wanted) else np.zeros(len(key), bool)
                who, key = who[hit], key[hit]
            keys, n = document_counts(who, key)
            return [0] * len(keys), [keys.view(np.int64).tolist(), n.tolist()]
        return run

    counts = map_texts(docs, {}, F.col(text_col), "k bigint, n bigint", count_work, TEXT_CHARS)
    counts = counts if few else counts.join(loud, "k", "left_semi")
    counts = counts.groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") > rare_share * documents).collect()
    return np.array([r["k"] for r in counts], np.int64).view(np.uint64), np.array([r["n"] for r in counts], float), documents, rare_share


def _runs(batch: pa.RecordBatch, chunk: str = "_chunk", text: str = "_text") -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows of one chunk with about ``TEXT_CHARS`` characters of text (null: 0); a longer text is a run of its own."""
    of = batch.column(batch.schema.get_field_index(chunk)).to_numpy()
    size = pc.fill_null(pc.utf8_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    lo = 0
    while lo < len(of):
        other = np.flatnonzero(of[lo:] != of[lo])
        stop = lo + int(other[0]) if len(other) else len(of)
        hi = min(stop, max(lo + 1, int(np.searchsorted(end, end[lo] - size[lo] + TEXT_CHARS, side="right"))))
        yield lo, hi
        lo = hi


def rare_counts(plain: DataFrame, shared: Broadcast, shift: int, slot_bits: int) -> DataFrame:
    """``_chunk, _keys, _counts``: for the rows ``_rid, _text`` of a chunk (``_rid`` shifted right by ``shift``) those of their
    shingles that two documents or more hold, with the exact number of documents, in several rows. Common ones
    (``common_shingles``) are left out: every task has them.

    The different shingles of a chunk are dealt out by their first bits, each with the number of documents of the chunk that hold it, so a
    shingle has at most one entry per chunk (or run of a chunk that several tasks read) and no task gets more of it than there are chunks."""
    slots = 1 << slot_bits

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.sort(shared.value[0])
        for batch in batches:
            chunk, texts = batch.column(0), batch.column(1)
            for lo, hi in _runs(batch):
                keys, n = document_counts(*all_shingles([t or "" for t in texts.slice(lo, hi - lo).to_pylist()]))
                rare = ~looked_up(keys, common)[0]
                keys, n = keys[rare], n[rare].astype(np.uint32)
                cut = np.searchsorted(keys >> np.uint64(63) >> np.uint64(1) if slots == 1 else keys >> np.uint64(64 - slot_bits), np.arange(slots + 1, dtype=np.uint64))
                some = np.flatnonzero(cut[1:] > cut[:-1])
                yield pa.RecordBatch.from_pydict({
                    "_slot": pa.array(some, pa.int32()), "_chunk": pa.array([chunk[lo].as_py()] * len(some), pa.int64()),
                    "_keys": pa.array([keys[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary()),
                    "_counts": pa.array([n[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary())})

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        keys, n = np.frombuffer(b"".join(frame["_keys"]), np.uint64), np.frombuffer(b"".join(frame["_counts"]), np.uint32)
        cut = np.concatenate([[0], np.cumsum([len(k) // 8 for k in frame["_keys"]])])
        order = np.argsort(keys)
        first = np.ones(len(keys), bool)
        first[1:] = keys[order[1:]] != keys[order[:-1]]
        total = np.add.reduceat(n[order], np.flatnonzero(first), dtype=np.int64)
        found = np.empty(len(keys), np.int64)
        found[order] = total[np.cumsum(first) - 1]
        out = []
        for chunk, lo, hi in zip(frame["_chunk"], cut, cut[1:]):
            again = np.flatnonzero(found[lo:hi] > 1)
            if len(again):
                out.append((chunk, keys[lo:hi][again].tobytes(), packed_counts(found[lo:hi][again])))
        return pd.DataFrame(out, columns=["_chunk", "_keys", "_counts"]).astype({"_chunk": "int64"})

    dealt = plain.select(F.shiftright("_rid", shift).alias("_chunk"), F.col("_text").cast("string").alias("_text"))
    dealt = dealt.mapInArrow(deal, "_slot int, _chunk long, _keys binary, _counts binary")
    return materialize(dealt.groupBy("_slot").applyInPandas(count, "_chunk long, _keys binary, _counts binary"), "shingle-counts")


def signatures(plain: DataFrame, shared: Broadcast, rare: DataFrame, shift: int, bands: int, rows: int) -> DataFrame:
    """``_rid, _id`` of every row with two digests of its set, and where it has shingles its band keys, its samples and the document counts
    of its shingles in their order. The texts of a chunk meet the counts of its shingles in one task, which reads them in turn."""
    texts = plain.select(F.shiftright("_rid", shift).alias("_chunk"), "_rid", "_id", F.col("_text").cast("string").alias("_text"))
    none = lambda c: F.lit(None).cast(texts.schema[c].dataType).alias(c)
    both = texts.select("*", *[F.lit(None).cast("binary").alias(c) for c in ("_keys", "_counts")]).unionAll(
        rare.select("_chunk", none("_rid"), none("_id"), none("_text"), "_keys", "_counts"))
    both = both.repartition("_chunk").sortWithinPartitions("_chunk", F.col("_keys").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(*shared.value[:3])
        here, keys, counts, table = None, [], [], None
        for batch in batches:
            chunk, text = batch.column(0), batch.column(3)
            known = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            for lo, hi in _runs(batch):
                if chunk[lo].as_py() != here:
                    here, keys, counts, table = chunk[lo].as_py(), [], [], None
                told = int(known[lo:hi].sum())  # these stand first
                for k, n in zip(batch.column(4).slice(lo, told).to_pylist(), batch.column(5).slice(lo, told).to_pylist()):
                    keys.append(np.frombuffer(k, np.uint64))
                    counts.append(unpacked_counts(n))
                lo += told
                if lo == hi:
                    continue
                if table is None:
                    all_keys, n = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
                    order = np.argsort(all_keys)
                    table, keys, counts = (all_keys[order], n[order]), [], []
                texts = [t or "" for t in text.slice(lo, hi - lo).to_pylist()]
                who, key, count = shingles(texts)
                documents = weights.documents_of(key, *table)
                have, band, samples = band_keys(who, key, weights(count, documents), len(texts), bands, rows)
                d = [np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)]
                for x, salt in zip(d, (1, 2)):
                    np.add.at(x, who, mix(mix(key + np.uint64(salt)) * count.astype(np.uint64) + np.uint64(salt)))
                found: list = [None] * len(texts)
                packed: list = [None] * len(texts)
                counted: list = [None] * len(texts)
                cut = np.searchsorted(who, np.arange(len(texts) + 1))
                for i, row, sample in zip(have.tolist(), band.tolist(), samples):
                    found[i], packed[i], counted[i] = row, sample.tobytes(), packed_counts(documents[cut[i]:cut[i + 1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64)),
                     pa.array(found, pa.list_(pa.int64())), pa.array(packed, pa.binary()), pa.array(counted, pa.binary())],
                    names=["_rid", "_id", "_d1", "_d2", "_bands", "_samples", "_counts"])

    out = StructType([f for f in texts.schema if f.name in ("_rid", "_id")] + list(StructType.fromDDL("_d1 long, _d2 long, _bands array<bigint>, _samples binary, _counts binary")))
    return materialize(both.mapInArrow(run, out), "signatures")


def similarity(a_key: np.ndarray, a_weight: np.ndarray, b_key: np.ndarray, b_weight: np.ndarray) -> float:
    """Weighted Jaccard similarity of two weighted sets with sorted keys."""
    at = np.searchsorted(b_key, a_key)
    at[at == len(b_key)] = 0
    same = b_key[at] == a_key
    both = np.minimum(a_weight[same], b_weight[at[same]]).sum()
    return float(both / (a_weight.sum() + b_weight.sum() - both))


def _verify(pairs: DataFrame, sets: DataFrame, min_similarity: float) -> DataFrame:
    """``a, b`` of the pairs whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            keep = [similarity(np.frombuffer(ak.as_buffer(), np.uint64), np.frombuffer(aw.as_buffer(), np.float64),
                               np.frombuffer(bk.as_buffer(), np.uint64), np.frombuffer(bw.as_buffer(), np.float64)) >= min_similarity
                    for ak, aw, bk, bw in zip(cols["ak"], cols["aw"], cols["bk"], cols["bw"])]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([cols["a"].filter(mask), cols["b"].filter(mask)], names=["a", "b"])

    side = lambda x: sets.select(F.col("_rid").alias(x), F.col("k").alias(x + "k"), F.col("w").alias(x + "w"))
    found = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ak", "aw", "bk", "bw").mapInArrow(run, "a long, b long")
    return materialize(found, "similar-pairs")


def _star_links(star: DataFrame, sets: DataFrame, min_similarity: float) -> DataFrame:
    """``a, b``: links that join what the pairs (member ``x``, hub ``y``, ``_mates`` of the hub) can join.

    A member meets its hub with the most mates first, and of its other hubs then only those of other classes, so
    its set travels about once and not once per hub."""
    pair = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    best = star.groupBy("x").agg(F.max(F.struct("_mates", (-F.col("y")).alias("_neg")))["_neg"].alias("_neg")).select("x", (-F.col("_neg")).alias("y"))
    first = materialize(best.select(*pair).distinct(), "star-pairs")
    near = _verify(first, sets, min_similarity)
    roots = components(near)
    at = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias("_" + c))
    apart = star.join(at("x"), "x", "left").join(at("y"), "y", "left").where("coalesce(_x, x) <> coalesce(_y, y)")
    rest = materialize(apart.select(*pair).distinct().join(first, ["a", "b"], "left_anti"), "star-pairs")
    out = near.unionAll(_verify(rest, sets, min_similarity))
    drop(first, rest)
    return out


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_similarity: float = MIN_SIMILARITY,
                 bands: int = BANDS, rows: int = ROWS, rare_share: float = RARE_SHARE) -> DataFrame:
    """One row per input row: ``_rid, id_col, class_id, class_size, kept``.

    ``class_id`` is the smallest id of the class (null only if all its ids are); the first row with it is kept.
    Texts without a word (null, empty, punctuation only) are classes of their own, repeated ones too; other rows with
    the same shingles are one class. Other columns are ignored; an empty table gives no rows.
    ``docs`` must be a stored table.

    Scale: documents with equal sets are merged first. In a bucket (documents that agree in a band) all
    are compared with one hub, the member with the most bucket mates, so a large group of near copies
    costs one comparison each. Pairs of a bucket that are then still in different classes and agree in enough
    samples are compared as well, inside tasks that return links only, so no link between classes is lost.
    Every shingle's documents are counted: the different shingles of a chunk of texts travel once (8 bytes each), those in two
    documents or more travel back to their chunk. Only common shingles reach the driver.
    """
    spark = docs.sparkSession
    plain = with_row_id(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    shared = spark.sparkContext.broadcast(common_shingles(docs.select(F.col(text_col).alias("_text")), "_text", rare_share))
    chars, n = plain.agg(F.sum(F.length("_text")), F.count(F.lit(1))).first()
    shift = min(16, int(math.log2(max(1, TEXT_CHARS * n // max(1, chars or 0)))))  # about TEXT_CHARS characters a chunk
    rare = rare_counts(plain, shared, shift, math.ceil(math.log2(max(1, (chars or 0) / 6 / SLOT_SHINGLES))))
    signed = signatures(plain, shared, rare, shift, bands, rows)
    drop(rare)
    worded = signed.where("_bands IS NOT NULL")
    reps = materialize(worded.groupBy("_d1", "_d2").agg(F.min("_rid").alias("_rep")), "sets")
    own = worded.join(reps.select("_rep"), F.col("_rid") == F.col("_rep")).select("_rid", F.posexplode("_bands").alias("_band", "_key"))
    crowded = own.groupBy("_band", "_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = materialize(own.join(crowded, ["_band", "_key"]), "buckets")
    wanted = members.groupBy("_rid").agg(F.sum("_n").alias("_mates"))

    def set_work():
        weights = Weights(*shared.value[:3])

        def run(texts: list[str], counts: list[bytes]):
            who, key, count = shingles(texts)
            w = weights(count, np.concatenate([unpacked_counts(c) for c in counts]))
            cut = np.searchsorted(who, np.arange(len(texts) + 1))
            return None, [[key[a:b].tobytes() for a, b in zip(cut, cut[1:])], [w[a:b].tobytes() for a, b in zip(cut, cut[1:])]]
        return run

    whole = plain.join(signed.select("_rid", "_counts").join(wanted.select("_rid"), "_rid"), "_rid")
    sets = materialize(map_texts(whole, {"_rid": F.col("_rid")}, F.col("_text"), "k binary, w binary", set_work, TEXT_CHARS, F.col("_counts")), "shingle-sets")
    ranked = members.join(wanted, "_rid")
    hubs = ranked.groupBy("_band", "_key").agg(F.max(F.struct("_mates", (-F.col("_rid")).alias("_neg"))).alias("_hub"))
    star = ranked.join(hubs, ["_band", "_key"]).select(F.col("_rid").alias("x"), (-F.col("_hub._neg")).alias("y"), F.col("_hub._mates").alias("_mates")).where("x <> y")
    star = materialize(star.groupBy("x", "y").agg(F.max("_mates").alias("_mates")), "star-pairs")
    near = _star_links(star, sets, min_similarity)
    drop(star)
    links = near.unionAll(_mixed_links(members, signed, sets, components(near), MIN_AGREEMENT, min_similarity))
    drop(members, sets)
    roots = components(links).withColumnRenamed("node", "_rep")
    classes = reps.join(roots, "_rep", "left").select("_d1", "_d2", F.coalesce("root", "_rep").alias("_root"))
    rows_in = worded.select("_rid", "_id", "_d1", "_d2").join(classes, ["_d1", "_d2"]).select("_rid", "_id", "_root")
    rows_in = materialize(rows_in.unionAll(signed.where("_bands IS NULL").select("_rid", "_id", F.col("_rid").alias("_root"))), "class-rows")
    drop(signed, reps)
    first = rows_in.groupBy("_root").agg(F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                                         F.min(F.struct(F.col("_id").isNull().alias("z"), F.col("_id").alias("i"), F.col("_rid").alias("r")))["r"].alias("_first"))
    return rows_in.join(first, "_root").select("_rid", F.col("_id").alias(id_col), "class_id", "class_size", (F.col("_rid") == F.col("_first")).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but one document of each near-duplicate class."""
    kept = near_classes(docs, **options).where("kept").select("_rid")
    return with_row_id(docs).join(kept, "_rid", "left_semi").select(*docs.columns)
