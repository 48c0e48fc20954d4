"""Words of many texts at once, as NumPy arrays of code points."""

from __future__ import annotations

import sys
import types
from dataclasses import dataclass

import numpy as np

BASE = 0x9E3779B97F4A7C15


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker. (Functions travel to tasks by value, so
    this package's own globals are new in every task.)"""
    return sys.modules.setdefault("_tidemill_worker_cache", types.ModuleType("_tidemill_worker_cache")).__dict__


def char_table(kind: str) -> np.ndarray:
    """Whether ``str.kind`` (``isalpha``, ``isalnum``) holds for each code point (built once per worker)."""
    cache = worker_cache()
    if kind not in cache:
        test = getattr(str, kind)
        cache[kind] = np.fromiter((test(chr(c)) for c in range(0x110000)), bool, 0x110000)
    return cache[kind]


@dataclass
class Words:
    """Code points of texts in lower case, word bounds, chain of each word, text of each word."""

    cp: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    chain: np.ndarray
    text: np.ndarray


def split_words(texts: list[str], kind: str, chain_words: int = 1 << 40) -> Words:
    """Maximal runs of characters of a kind; chains are lines, cut after ``chain_words`` words."""
    lowered = [t.lower() for t in texts]
    cp = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = char_table(kind)[cp]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in lowered]), begin, side="right")
    line = np.searchsorted(np.flatnonzero(cp == 10), begin)
    first = np.ones(len(begin), bool)
    first[1:] = line[1:] != line[:-1]
    if len(begin):
        at = np.arange(len(begin))
        first |= (at - np.maximum.accumulate(np.where(first, at, 0))) % chain_words == 0
    return Words(cp, begin, stop, np.cumsum(first) - 1, text)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2**64, by doubling."""
    out = np.ones(n, np.uint64)
    done, factor = 1, base
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(factor)
        done, factor = done + more, factor * factor % (1 << 64)
    return out


def run_hashes(values: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of every run ``values[begin:stop]``: prefix sums of value * BASE**position modulo 2**64, shifted
    back to position 0, so equal runs hash equal wherever they stand."""
    n, cache = len(values) + 1, worker_cache()
    if len(cache.get("powers", ((),))[0]) < n:
        cache["powers"] = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)
    power, inverse = cache["powers"]
    total = np.zeros(n, np.uint64)
    scaled = values.astype(np.uint64)
    scaled += np.uint64(1)
    scaled *= power[:n - 1]
    np.cumsum(scaled, out=total[1:])
    return mix((total[stop] - total[begin]) * inverse[begin])


class KeyTable:
    """Row numbers of 64-bit keys, looked up many at a time."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is new."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.at[i], -1)

    def add(self, keys: np.ndarray) -> None:
        """Give new, different keys the next rows."""
        keys, at = np.concatenate([self.keys, keys]), np.concatenate([self.at, len(self.keys) + np.arange(len(keys))])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at = keys[order], at[order]

    def full(self) -> bool:
        return len(self.keys) > self.limit
