"""Secrets in texts: fixed patterns, and password guess costs in credential contexts.

Values that follow a credential word are segmented at minimum cost into words, dates,
repeats, sequences, keyboard walks and brute-force characters by dynamic programming; the cost
is the base-10 logarithm of the guesses that an attacker who knows these patterns needs. Values
that are hard to guess are secrets even where no fixed pattern matches them.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._shared import map_texts

# The base patterns with the least length of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so a shorter run cannot hide a longer one
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_MIN, ACCESS_MIN = 12, 18
KINDS = ("assign", "access", "hex", "guess")

CONTEXT_WORDS = ("passwor", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "api", "credential", "auth")
CONTEXT = re.compile(r"""(?:pass(?:word|wort|wd|phrase|code)|pwd|secret|token|api[_-]?key|credentials?|auth(?:orization)?)["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*["'`]?([^\s"'`<>]+)""", re.I | re.A)
TRAILING = ".,;:!?)]}"
MIN_LENGTH = 6  # shorter values are open to brute force whatever they are
MIN_LOG10_GUESSES = 9.0

# Common passwords and words, most common first.
COMMON_WORDS = tuple("""password 123456 qwerty admin letmein welcome monkey dragon master login abc123 iloveyou football baseball
    sunshine princess shadow superman michael secret hello freedom whatever trustno1 starwars access batman killer hunter summer
    winter spring autumn monday friday love test user root guest default changeme example token none null true false undefined
    required optional string value your here insert enter type name email mail key api private public server client database
    the and for that with this from have not are was you they will would there their what about which when make can like time
    just know take people into year good some could them see other than then now look only come its over think also back after
    use two how our work first well way even new want because any these give day most""".split())
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop")
LEET = str.maketrans("@4310$5!7", "aaeiossit")
DATE = re.compile(r"(?:(?:19|20)\d\d([-./]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-./]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d)")
CLASS_SIZES = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))


def char_cost(c: str) -> float:
    """Log10 of the alphabet that a brute-force character comes from."""
    if not c.isascii():
        return 2.0
    for test, n in CLASS_SIZES:
        if test(c):
            return math.log10(n)
    return math.log10(33)


def _case_cost(text: str) -> float:
    if text.islower() or not text.isalpha():
        return 0.0
    return 0.3 if text.isupper() or text.istitle() else 0.3 * sum(c.isupper() for c in text)


#: Repeats of blocks of this length or more are found by the last place of a run of so many characters.
GRAM = 8


def shared_end(text: str, end: int, back: int) -> int:
    """How many characters up to ``end`` equal those ``back`` before them, found by doubling and halving."""
    most, n, size = end - back, 0, 64
    while size:
        if n + size <= most and text[end - n - size:end - n] == text[end - back - n - size:end - back - n]:
            n += size
            size *= 2
        else:
            size //= 2
    return n


def vocabulary_words(path: str) -> list[str]:
    """Words of a public tokenizer's vocabulary in the order of their ids, the most common first: the bounded dictionary
    (tens of thousands of words) of the query. Marks of word starts and ends are taken off."""
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    plain = (w.removesuffix("</w>").lstrip("Ġ▁").lower() for w in sorted(ids, key=ids.get))
    return list(dict.fromkeys(w for w in plain if len(w) > 2 and w.isalpha()))


class GuessCost:
    """Minimum-cost segmentation; ``words``, ranked from the most common on, follow the common ones."""

    def __init__(self, words: Sequence[str] = COMMON_WORDS):
        self.rank = {}
        for i, w in enumerate(dict.fromkeys([*COMMON_WORDS, *words])):
            if len(w) > 2:
                self.rank.setdefault(w, i + 1)
        self.longest = max(map(len, self.rank), default=0)
        near = set()
        for row in KEY_ROWS:
            near |= {row[i:i + 2] for i in range(len(row) - 1)}
        self.near = near | {x[::-1] for x in near}

    def __call__(self, value: str) -> float:
        n, low = len(value), value.lower()
        plain = low.translate(LEET)
        best = [0.0] + [math.inf] * n
        walk = turns = repeat = step = 0
        # letters up to here that equal those k before: all short periods, and longer ones while they go on
        open_ = dict.fromkeys(range(2, GRAM), 0)
        seen: dict[str, int] = {}
        for i in range(1, n + 1):
            c = best[i - 1] + char_cost(value[i - 1])
            # words, as written or with look-alike characters
            for j in range(max(0, i - self.longest), i - 2):
                for text, extra in ((low, 0.0), (plain, 0.3)):
                    r = self.rank.get(text[j:i])
                    if r:
                        c = min(c, best[j] + math.log10(r + 1) + _case_cost(value[j:i]) + extra + 0.3)
                        break
            # runs ending here: the same character, a constant step, neighbouring keys; any part of a run may start the segment
            if i > 1:
                d = ord(low[i - 1]) - ord(low[i - 2])
                repeat = repeat + 1 if d == 0 else 1
                step = step + 1 if d == prior and abs(d) == 1 else (2 if abs(d) == 1 else 1)
                if low[i - 2:i] in self.near:
                    walk += 1
                    turns += d != prior
                else:
                    walk, turns = 1, 0
                prior = d
            else:
                repeat = step = walk = 1
                prior = 0
            for run, base in ((repeat, char_cost(value[i - 1])), (step, 1.7), (walk, 1.7 + 0.7 * turns)):
                if run >= 3:
                    c = min(c, best[i - run] + base + math.log10(run))
            # blocks that were just said, of any length, as often as they were
            if i >= 2 * GRAM:
                ago = i - seen.get(low[i - GRAM:i], i)
                if ago >= GRAM and ago not in open_:
                    open_[ago] = -1
            for k in list(open_):
                if i <= k or low[i - 1] != low[i - 1 - k]:
                    open_[k] = 0
                    if k >= GRAM:
                        del open_[k]
                    continue
                open_[k] = shared_end(low, i, k) if open_[k] < 0 else open_[k] + 1
                m = open_[k] // k
                if m:
                    c = min(c, best[i - m * k] + math.log10(m + 1))
            if i >= GRAM:
                seen[low[i - GRAM:i]] = i
            # dates
            for k in (4, 6, 7, 8, 9, 10):
                if k <= i and value[i - k].isdigit() and value[i - 1].isdigit() and DATE.fullmatch(value, i - k, i):
                    c = min(c, best[i - k] + (2.1 if k == 4 else 4.6))
            best[i] = c
        return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, leftmost and non-overlapping per kind."""
    out, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def guess_spans(text: str, cost: GuessCost, least: float, covered: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """Values in credential contexts that no base span covers and that cost ``least`` or more."""
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        start, value = m.start(1), m[1].rstrip(TRAILING)
        end = start + len(value)
        if len(value) >= MIN_LENGTH and not any(a <= start and end <= b for a, _, b in covered):
            c = cost(value)
            if c >= least:
                out.append((start, 3, end, c))
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_log10_guesses: float = MIN_LOG10_GUESSES, words: Sequence[str] = COMMON_WORDS) -> DataFrame:
    """One row per input row: ``id_col, spans`` with ``spans`` an array of
    ``(kind, start, end, log10_guesses)`` by start, then kind (code points, end exclusive).

    Kinds: ``assign``, ``access`` and ``hex`` are the fixed patterns (no cost given), ``guess`` a value in a
    credential context that no fixed pattern covers. Null or empty text has no spans; null
    ids and repeated rows are passed on; other columns are ignored. Rows are independent: no
    shuffle, and the cost is linear in a value's length, however long it is."""
    words = tuple(words)

    def work():
        cost = GuessCost(words)

        def run(texts: list[str]):
            found = []
            for text in texts:
                base = base_spans(text)
                spans = [(*s, None) for s in base] + guess_spans(text, cost, min_log10_guesses, base)
                spans.sort(key=lambda s: s[:2])
                found.append([{"kind": KINDS[k], "start": a, "end": b, "log10_guesses": c} for a, k, b, c in spans])
            return None, [found]
        return run

    return map_texts(docs, {id_col: F.col(id_col)}, F.col(text_col),
                     "spans array<struct<kind: string, start: bigint, end: bigint, log10_guesses: double>>", work)
