"""Packing token pieces into sequences: vector bin packing by the dot-product heuristic.

Each piece has a demand vector (tokens, segments, loss-bearing tokens) and each sequence a
capacity vector. A sequence is filled by taking, again and again, the fitting piece whose
demand has the largest dot product with the room that is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._shared import map_texts, materialize
from tidemill.llm._text import KeyTable, run_hashes, worker_cache

MAX_TOKENS = 4096
MAX_SEGMENTS = 1024
END_ID = 2
#: Pieces that one task packs together.
GROUP_PIECES = 20_000
#: Word encodings that a worker remembers, and characters that it cuts into words at a time.
PART_CHARS = 4_000_000
CACHE_WORDS = 800_000


class WordEncoder:
    """Token ids of many texts by a ``tokenizers`` file whose pre-tokenizer cuts at white space.

    Texts of ASCII and Latin-1 letters are cut into the tokenizer's words for a whole batch at once
    (a run of letters, one digit, a run of other characters, an English contraction), and each
    different word is encoded once by the tokenizer's own model. Texts with any other character,
    or with a special token's string, go through the tokenizer whole. Both give the same ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        pre = self.tok.pre_tokenizer
        self.visible = str.maketrans({chr(c): pre.pre_tokenize_str(chr(c))[0][0] for c in (*range(33, 127), *range(0xC0, 0x100))})
        self.known = KeyTable(CACHE_WORDS)
        self.flat, self.size = np.empty(0, np.uint32), np.empty(0, np.int64)
        kind = np.full(256, 4, np.uint8)  # 0 space, 1 letter, 2 digit, 3 other, 4 not handled here
        kind[[9, 10, 13, 32]] = 0
        kind[33:127] = 3
        kind[48:58] = 2
        kind[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = 1
        kind[[0xD7, 0xF7]] = 3
        self.kind = kind
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        lower[0xC0:0xDF] += 32
        lower[0xD7] = 0xD7
        self.lower = lower

    def _plain(self, text: str) -> bytes | None:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if any(s in text for s in self.special):
            return None
        return raw

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if any(len(t) > PART_CHARS for t in texts):
            return [np.concatenate(self._encode(list(_parts(t))) or [np.empty(0, np.uint32)]) for t in texts]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        raws = [self._plain(t) for t in texts]
        if any(r is not None for r in raws):
            bad = self.kind[np.frombuffer(b" ".join(r for r in raws if r is not None), np.uint8)] == 4
            if bad.any():
                raws = [None if r is None or (self.kind[np.frombuffer(r, np.uint8)] == 4).any() else r for r in raws]
        out: list = [None] * len(texts)
        whole = [i for i, r in enumerate(raws) if r is None]
        for i, e in zip(whole, self.tok.encode_batch([texts[i] for i in whole], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        fast = [i for i, r in enumerate(raws) if r is not None]
        if fast:
            for i, ids in zip(fast, self._encode_plain([raws[i] for i in fast])):
                out[i] = ids
        return out

    def _encode_plain(self, raws: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"\n".join(raws) + b"\n  ", np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raws])
        cp = self.lower[data]
        kind = self.kind[cp]
        start = np.ones(len(cp), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        quote = np.flatnonzero((cp[:-2] == 39) & start[:-2])
        if len(quote):  # 's 't 'm 'd, 're 've 'll
            a, b = cp[quote + 1], cp[quote + 2]
            one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
            two = ~one & (((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108)))
            for hit, n in ((quote[one], 2), (quote[two], 3)):
                start[hit + 1] = False
                start[hit + n] = True
        begin = np.flatnonzero(start)
        stop = np.append(begin[1:], len(cp))
        keep = kind[begin] != 0
        begin, stop = begin[keep], stop[keep]
        word = run_hashes(cp, begin, stop)
        keys, first, which = np.unique(word, return_index=True, return_inverse=True)
        if self.known.full():
            self.known.clear()
            self.flat, self.size = np.empty(0, np.uint32), np.empty(0, np.int64)
        new = np.flatnonzero(self.known.rows(keys) < 0)
        low, model, visible, found = cp.tobytes(), self.tok.model, self.visible, []
        for i in first[new].tolist():
            found.append([t.id for t in model.tokenize(low[begin[i]:stop[i]].decode("latin-1").translate(visible))])
        self.known.add(keys[new])
        self.size = np.concatenate([self.size, np.array([len(x) for x in found], np.int64)])
        self.flat = np.concatenate([self.flat, np.array([x for ids in found for x in ids], np.uint32)])
        if not len(keys):
            return [np.empty(0, np.uint32) for _ in raws]
        row = self.known.rows(keys)
        size, at = self.size[row], (np.cumsum(self.size) - self.size)[row]
        n = size[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(at[which] - upto[:-1], n) + np.arange(upto[-1])]
        cut = upto[np.searchsorted(begin, ends, side="left")]
        return np.split(ids, cut[:-1])


def _parts(text: str, chars: int = PART_CHARS) -> Iterator[str]:
    """A long text in parts cut before an ASCII space or line end: no word spans a cut."""
    lo = 0
    while len(text) - lo > chars:
        hi = max(text.rfind(" ", lo + 1, lo + chars), text.rfind("\n", lo + 1, lo + chars))
        if hi < 0:
            break
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker."""
    cache = worker_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = WordEncoder(path)
    return cache["encoder", path]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS, end_id: int | None = END_ID) -> DataFrame:
    """Cut each document's ids (its text's ids, then ``end_id``) into pieces of ``max_tokens`` and
    a rest: ``id_col, start, length, ids_crc32, doc_tokens, loss``. A document without ids
    gives no piece. Every id of a document bears loss. Only piece rows leave the Python worker."""
    tail = np.empty(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)

    def work():
        enc = encoder(tokenizer)

        def run(texts: list[str]):
            rows, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(enc.encode(texts)):
                ids = np.concatenate([ids, tail]).astype("<u4")
                for s in range(0, len(ids), max_tokens):
                    piece = ids[s:s + max_tokens]
                    rows.append(i)
                    start.append(s)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
            return rows, [start, length, crc, total, length]
        return run

    return map_texts(docs, {id_col: F.col(id_col)}, F.col(text_col),
                     "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, loss bigint", work)


def dot_product_pack(demand: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins and positions of ``demand`` rows (n x d, each fitting ``capacity`` alone).

    Rows of equal demand are interchangeable, so each step looks at different demands only."""
    kinds, which = np.unique(demand, axis=0, return_inverse=True)
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    left = np.bincount(which, minlength=len(kinds))
    upto = np.cumsum(left)
    share = kinds / capacity
    bins, place = np.empty(len(demand), np.int64), np.empty(len(demand), np.int64)
    alive = np.arange(len(kinds))
    current, room, rank = 0, capacity.astype(float).copy(), 0
    while len(alive):
        fits = alive[(kinds[alive] <= room).all(axis=1)]
        if not len(fits):
            current, room, rank = current + 1, capacity.astype(float).copy(), 0
            continue
        k = fits[np.argmax(share[fits] @ (room / capacity))]
        item = order[upto[k] - left[k]]
        bins[item], place[item] = current, rank
        room, rank = room - kinds[k], rank + 1
        left[k] -= 1
        if not left[k]:
            alive = alive[alive != k]
    return bins, place


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_TOKENS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` and ``loss``.

    A sequence holds at most ``max_tokens`` tokens, ``max_segments`` pieces and ``max_loss``
    loss-bearing tokens; offsets in it are gapless from 0. A piece beyond a limit by
    itself raises an error (``token_pieces`` makes none). ``pieces`` must be stored. Pieces are dealt by
    hash into groups of about ``group_pieces``, each packed in one task, so memory per task
    is bounded and only the last sequence of a group can be left short of pieces.
    """
    groups = int(pieces.count() // group_pieces) + 1
    limits = np.array([max_tokens, max_segments, max_loss], float)
    dealt = pieces.withColumn("_g", F.pmod(F.xxhash64(*pieces.columns), F.lit(groups)))

    def place(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([c for c in frame.columns if c != "_g"], kind="stable", ignore_index=True)
        length = frame["length"].to_numpy()
        demand = np.stack([length, np.ones(len(frame), np.int64), frame["loss"].to_numpy()], axis=1)
        if (demand > limits).any():
            raise ValueError("a piece exceeds the limits of a sequence")
        bins, rank = dot_product_pack(demand, limits)
        order = np.lexsort((rank, bins))
        upto = np.cumsum(length[order]) - length[order]
        first = np.ones(len(order), bool)
        first[1:] = bins[order][1:] != bins[order][:-1]
        offset = np.empty(len(order), np.int64)
        offset[order] = upto - np.maximum.accumulate(np.where(first, upto, 0))
        frame["sequence_id"] = (int(key[0]) << 32) + bins
        frame["offset"] = offset
        return frame.drop(columns="_g")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_g").applyInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Tokenise, cut and pack documents. Null text counts as empty: its only id is the end id.
    Repeated rows are separate documents; an empty table gives no rows."""
    return pack(materialize(token_pieces(docs, tokenizer, **options), "pieces"))
