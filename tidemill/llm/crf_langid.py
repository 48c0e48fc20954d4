"""Language identification by a linear-chain conditional random field over words.

Every word of a line is labelled with a language: affix, character n-gram and lexicon features
(hashed) score it, learned transitions tie neighbours, and forward-backward gives each word's
marginal, also in text that switches languages. A document's language is the one with the
largest mean marginal. The field is trained here, on a bounded sample of labelled documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm._shared import map_texts, materialize, with_row_id
from tidemill.llm._text import KeyTable, Words, mix, run_hashes, split_words, worker_cache

FEATURE_BITS = 17
#: Labelled documents per language, and words of each, that the field is trained on.
TRAIN_DOCS = 150
TRAIN_WORDS = 300
EPOCHS = 4
#: Words of one chain: longer lines are cut.
CHAIN_WORDS = 256
#: Words whose scores a worker remembers.
KNOWN_WORDS = 300_000
UNKNOWN = "und"

def distinct_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every different word, where it first occurs, and which one each word is."""
    keys, first, which = np.unique(run_hashes(w.cp, w.begin, w.stop), return_index=True, return_inverse=True)
    return keys, first, which


def features(w: Words, keys: np.ndarray, first: np.ndarray, bits: int = FEATURE_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(word, feature)`` lists, each by word, of the different words: the whole word, prefixes
    and suffixes of one to three letters, and n-grams of two and three with the word's bounds."""
    n = w.stop[first] - w.begin[first]
    size = n + 2
    word = np.repeat(np.arange(len(first)), size)
    at = np.arange(len(word)) - (np.cumsum(size) - size)[word]
    inside = (at > 0) & (at <= n[word])
    c = np.where(at == 0, np.uint64(4), np.uint64(5))
    c[inside] = w.cp[w.begin[first][word[inside]] + at[inside] - 1].astype(np.uint64) + np.uint64(3)
    left = size[word] - at  # characters from here to the end mark, both included
    out = [(np.arange(len(first)), keys ^ np.uint64(0xA5A5))]
    gram = c
    for k in (2, 3, 4):
        gram = gram[:-1] * np.uint64(0x100000001B3) + c[k - 1:]
        start, finish = np.flatnonzero((left[:len(gram)] >= k) & (at[:len(gram)] == 0)), np.flatnonzero(left[:len(gram)] == k)
        if k < 4:
            ok = np.flatnonzero(left[:len(gram)] >= k)
            out.append((word[ok], gram[ok] + np.uint64(k << 56)))
        out.append((word[start], gram[start] + np.uint64((k + 16) << 56)))
        out.append((word[finish], gram[finish] + np.uint64((k + 32) << 56)))
    return [(who, (mix(g) >> np.uint64(64 - bits)).astype(np.int64)) for who, g in out]


def feature_sums(weights: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], words: int) -> np.ndarray:
    """Sum of the feature weights of each word."""
    out = np.zeros((words, weights.shape[1]))
    for who, feature in found:
        if len(who):
            at = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            out[who[at]] += np.add.reduceat(weights[feature], at, axis=0)
    return out


def forward_backward(score: np.ndarray, chain: np.ndarray, step: np.ndarray, start: np.ndarray, moves: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of every word (rows in chain order) and, if asked for, the expected transitions
    summed up. Words are laid out by position in their chain, longest chains first, so that all
    chains advance together over contiguous rows."""
    counts = np.bincount(chain)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    time = np.arange(len(chain)) - (np.cumsum(counts) - counts)[chain]
    alive = np.bincount(time)  # chains that reach position t
    begin = np.cumsum(alive) - alive
    place = begin[time] + rank[chain]
    emit = np.empty_like(score)
    emit[place] = np.exp(score - score.max(axis=1, keepdims=True))
    move = np.exp(step)
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    for t, (a, n) in enumerate(zip(begin, alive)):
        prior = np.exp(start) if t == 0 else forward[begin[t - 1]:begin[t - 1] + n] @ move
        f = prior * emit[a:a + n]
        forward[a:a + n] = f / (f @ np.ones((len(start), 1)))
    for t in range(len(alive) - 2, -1, -1):
        a, n = begin[t + 1], alive[t + 1]
        b = (emit[a:a + n] * backward[a:a + n]) @ move.T
        backward[begin[t]:begin[t] + n] = b / (b @ np.ones((len(start), 1)))
    marginal = forward * backward
    marginal /= marginal.sum(axis=1, keepdims=True)
    expected = None
    if moves:
        later = place[np.flatnonzero(time > 0)]
        before = place[np.flatnonzero(time > 0) - 1]
        pair = forward[before][:, :, None] * move[None] * (emit[later] * backward[later])[:, None, :]
        expected = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return marginal[place], expected


@dataclass
class Field:
    """A trained field: labels, feature weights, transition and start scores (log scale)."""

    labels: list[str]
    weights: np.ndarray
    step: np.ndarray
    start: np.ndarray

    def word_scores(self, w: Words) -> np.ndarray:
        """Scores of every word; those of words seen before are remembered."""
        keys, first, which = distinct_words(w)
        known, scores = self.__dict__.setdefault("_known", [KeyTable(KNOWN_WORDS), np.empty((0, len(self.labels)))])
        if known.full():
            known.clear()
            scores = scores[:0]
        new = np.flatnonzero(known.rows(keys) < 0)
        if len(new):
            fresh = feature_sums(self.weights, features(w, keys[new], first[new]), len(new))
            known.add(keys[new])
            scores = np.concatenate([scores, fresh])
        self.__dict__["_known"][1] = scores
        return scores[known.rows(keys)][which]

    def marginals(self, texts: list[str]) -> tuple[Words, np.ndarray]:
        """Words of the texts and the marginal of every language for each of them."""
        w = split_words(texts, "isalpha", CHAIN_WORDS)
        if not len(w.begin):
            return w, np.empty((0, len(self.labels)))
        return w, forward_backward(self.word_scores(w), w.chain, self.step, self.start)[0]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and mean marginal of every text; ``und`` and 0 where there is no letter."""
        if not self.labels:
            return [(UNKNOWN, 0.0)] * len(texts)
        w, m = self.marginals(texts)
        n = np.bincount(w.text, minlength=len(texts))
        mean = np.stack([np.bincount(w.text, m[:, k], len(texts)) for k in range(len(self.labels))], axis=1) / np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)
        return [(self.labels[b], min(1.0, float(mean[i, b]))) if n[i] else (UNKNOWN, 0.0) for i, b in enumerate(best)]


def train(lines: list[tuple[str, str]], seed: int = 11, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.5) -> Field:
    """Fit by stochastic gradient ascent (AdaGrad) on the conditional likelihood.

    ``lines``: language and words joined by spaces. Training chains join two lines, half of them of
    other languages, so the transitions between languages are learned from switches."""
    labels = sorted({a for a, _ in lines})
    k, bits = len(labels), FEATURE_BITS
    field = Field(labels, np.zeros((1 << bits, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return field
    rng = np.random.default_rng(seed)
    gold = np.array([labels.index(a) for a, _ in lines])
    seen_w, seen_t, seen_s = np.full((1 << bits, k), 1e-6, np.float32), np.full((k, k), 1e-6), np.full(k, 1e-6)
    for _ in range(epochs):
        a, b = rng.permutation(len(lines)), rng.permutation(len(lines))
        for lo in range(0, len(lines), batch):
            pairs = list(zip(a[lo:lo + batch], b[lo:lo + batch]))
            w = split_words([f"{lines[i][1]} {lines[j][1]}" for i, j in pairs], "isalpha", CHAIN_WORDS)
            if not len(w.begin):
                continue
            cut = np.array([len(split_words([lines[i][1]], "isalpha", CHAIN_WORDS).begin) for i, _ in pairs])
            place = np.arange(len(w.text)) - np.searchsorted(w.text, w.text)
            first, second = gold[[i for i, _ in pairs]], gold[[j for _, j in pairs]]
            y = np.where(place < cut[w.text], first[w.text], second[w.text])
            keys, at, which = distinct_words(w)
            parts = features(w, keys, at)
            who, feature = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
            score = feature_sums(field.weights, parts, len(keys))[which]
            marginal, moves = forward_backward(score, w.chain, field.step, field.start, moves=True)
            error = -marginal
            error[np.arange(len(y)), y] += 1
            per_word = np.stack([np.bincount(which, error[:, c], len(keys)) for c in range(k)], axis=1)
            found, back = np.unique(feature, return_inverse=True)
            slope = np.stack([np.bincount(back, per_word[who, c], len(found)) for c in range(k)], axis=1) / len(pairs)
            later = np.flatnonzero(w.chain[1:] == w.chain[:-1]) + 1
            real = np.zeros((k, k))
            np.add.at(real, (y[later - 1], y[later]), 1)
            slope_t = (real - moves) / len(pairs)
            head = np.flatnonzero(np.concatenate([[True], w.chain[1:] != w.chain[:-1]]))
            slope_s = error[head].sum(axis=0) / len(pairs)
            for value, seen, g, rows in ((field.weights, seen_w, slope, found), (field.step, seen_t, slope_t, slice(None)), (field.start, seen_s, slope_s, slice(None))):
                seen[rows] += (g ** 2).astype(seen.dtype)
                value[rows] += (rate * g / np.sqrt(seen[rows])).astype(value.dtype)
    return field


def sample_lines(labelled: DataFrame, id_col: str, text_col: str, label_col: str, train_docs: int, train_words: int) -> list[tuple[str, str]]:
    """Lines of at most ``train_docs`` documents per language (smallest hashes) and ``train_words``
    words of each, spread over its lines: the only rows that reach the driver."""
    rows = with_row_id(labelled.select(F.col(id_col).alias("_id"), F.col(label_col).cast("string").alias("_label"), F.col(text_col).alias("_text")))
    rows = rows.where(F.col("_label").isNotNull() & F.col("_text").isNotNull() & (F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4)) != 2))
    rank = F.row_number().over(Window.partitionBy("_label").orderBy(F.xxhash64("_id", "_label"), "_rid"))
    chosen = rows.select("_rid", "_label", "_id").withColumn("_rank", rank).where(F.col("_rank") <= train_docs).select("_rid")
    chosen = materialize(chosen, "train-rows")  # stored, its size is known: Spark then need not shuffle the texts to meet it

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for label, text in zip(frame["_label"], frame["_text"]):
                lines = [x for x in text.split("\n") if any(map(str.isalpha, x))]
                total = sum(len(x.split()) for x in lines)
                stride, left = max(1, total // train_words), train_words
                for x in lines[::stride]:
                    words = x.split()[:min(left, 60)]
                    left -= len(words)
                    if words:
                        out.append((label, " ".join(words)))
                    if left <= 0:
                        break
            yield pd.DataFrame(out, columns=["label", "line"])

    picked = rows.join(chosen, "_rid").select("_label", "_text").mapInPandas(cut, "label string, line string")
    return sorted((r["label"], r["line"]) for r in picked.collect())


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             train_docs: int = TRAIN_DOCS, train_words: int = TRAIN_WORDS) -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score`` to the columns of ``docs`` (same-named columns are replaced).

    Learns from rows with text and a label whose ``crc32(id as text) mod 4`` is not 2 (a null id
    is not learned from); labels and ids take no part in a prediction. Null text and text without a
    letter give ``und`` and 0; without any labelled row every text does. Repeated rows get equal
    answers. Whole texts are read; rows are independent, so predicting needs no shuffle."""
    lines = sample_lines(docs, id_col, text_col, label_col, train_docs, train_words)
    field = train(lines)
    shared = docs.sparkSession.sparkContext.broadcast((field.labels, field.weights, field.step, field.start))

    def work():
        labels, weights, step, start = shared.value
        cache, name = worker_cache(), (zlib.crc32(weights.tobytes()), tuple(labels))
        if cache.get("field", (None,))[0] != name:  # one field at a time stays in the worker
            cache["field"] = name, Field(labels, weights, step, start)
        model = cache["field"][1]

        def run(texts: list[str]):
            found = model.predict(texts)
            return None, [[a for a, _ in found], [b for _, b in found]]
        return run

    keep = {c: F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "lang_score")}
    return map_texts(docs, keep, F.col(f"`{text_col}`"), "lang_pred string, lang_score double", work)


def crc_of(doc_id: object) -> int:
    """crc32 of an id as text, as Spark computes it."""
    return zlib.crc32(str(doc_id).encode())
