"""Spelling variants, vantage-point trees and conversation repair against brute force."""

import hashlib
import heapq
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import conversation_repair as cr
from tidemill.llm import queries as q
from tidemill.llm import spelling as sp
from tidemill.llm import vantage_trees as vt

# ---- spelling ---------------------------------------------------------------------------


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    by = dict(words)
    out, form = {}, {}
    for w, n in words:
        others = [o for o in by if near(w, o)]
        best = min(others, key=lambda o: (-by[o], o), default=None)
        form[w] = best if best is not None and by[best] >= ratio * n else None
        out[w] = (form[w], len(others), by[form[w]] if form[w] else None, n)
    result = []
    for w, (f, n_near, form_n, n) in out.items():
        root = w
        while form[root]:
            root = form[root]
        result.append((w, f, root, n, n_near, form_n))
    return sorted(result)


def got_variants(df, ratio=5):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in sp.variants(df, ratio).collect())


def test_variants_match_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abéz") for _ in range(rng.randint(1, 5))): rng.choice([1, 2, 5, 5, 10, 25, 125, 700]) for _ in range(400)}
    words |= {"aaaa": 1, "aaaaa": 5, "aaaaaa": 25, "aaaaaaa": 125, "b": 3, "": 9, "ß\U0001F600x": 4, "ß\U0001F601x": 20}
    df = spark.createDataFrame([(w, n, "other") for w, n in words.items()] + [(None, 5, "x"), ("nul", None, "x")], "word string, n long, root string")
    assert got_variants(df) == brute_variants(list(words.items()))
    assert got_variants(df, 2) == brute_variants(list(words.items()), 2)


def test_one_word_that_most_words_are_near_to(spark):
    words = [(f"ab{chr(0x4E00 + i)}d", i % 7 + 1) for i in range(3000)]  # one group, one character apart
    got = {w: (f, n_near) for w, f, _, _, n_near, _ in got_variants(spark.createDataFrame(words, "word string, n long"))}
    best = min((w for w, n in words if n == 7))
    assert all(got[w] == (best if n * 5 <= 7 else None, 2999) for w, n in words)


def test_counts_take_whole_texts_and_lower_ascii_only(spark):
    long_text = "Straße " * 200_000 + "ÉTÉÉTÉ étéété x1Straße"
    rows = [(1, long_text), (2, None), (3, ""), (None, "straße"), (2, "Straßen STRAßE")]
    got = {r["word"]: r["n"] for r in sp.count_words(spark.createDataFrame(rows, "doc_id long, text string"), min_count=1).collect()}
    assert got == {"straße": 200_003, "ÉtÉÉtÉ": 1, "étéété": 1, "straßen": 1}
    assert sp.count_words(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


def test_damage_follows_the_checksum(spark):
    docs = [(i, " ".join(w + "Abc" for w in ("hello", "wonder", "permute"))) for i in range(300)] + [(None, "wonderabc")]
    want = {}
    for i, text in docs:
        for w in text.lower().split():
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            w = w[:h % len(w)] + w[h % len(w) + 1:] if h % 7 == 0 else w
            want[w] = want.get(w, 0) + 1
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in sp.count_words(df, damage_every=7, min_count=1).collect()} == want


def test_spelling_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, word string, n int")
    assert sp.variants(sp.count_words(docs, 199)).count() == 0


# ---- vantage-point trees ------------------------------------------------------------------


def vector_table(spark, n=700, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)).astype(np.float32)
    x[100:200] = x[100] + 1e-3 * rng.standard_normal((100, dims))  # near copies
    x[200:420] = x[200]  # a third of all rows alike
    x[430] = 7 * x[431]
    rows = [(i, x[i].tolist()) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * dims), (n + 3, [1.0, None] + [0.0] * (dims - 2)), (n + 4, [float("nan")] + [1.0] * (dims - 1)),
             (n + 5, [float("inf")] * dims), (None, rows[3][1]), (50, rows[7][1]), (8000, [1.0, 2.0]), (8001, [2.0, 1.0]), (8050, [1.0, 1.0, 1.0])]
    return rows, spark.createDataFrame([(a, b, 5, 0.5) for a, b in rows], "vec_id long, embedding array<float>, rank int, score double")


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for i, v in good:
        if i % 50:
            continue
        same = [(j, w) for j, w in good if j != i and len(w) == len(v)]
        if not same:
            continue
        s = vt.cosine(np.repeat(v[None, :], len(same), 0), np.array([w for _, w in same]))
        best = sorted(zip((-s).tolist(), (j for j, _ in same)))[:k]
        out += [(i, r + 1, j, -d) for r, (d, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 60, "query_rows": 4, "task_shards": 2, "leaf_rows": 5}])
def test_factor_one_is_exact(spark, sizes):
    rows, df = vector_table(spark)
    got = vt.nearest(df, F.col("vec_id") % 50 == 0, **sizes)
    assert sorted(tuple(r) for r in got.collect()) == brute_nearest(rows, 5)


def test_fewer_candidates_than_asked_for_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in vt.nearest(df, F.col("vec_id") == 0, k=9).orderBy("rank").collect()] == [2, 1]
    assert vt.nearest(df, F.col("vec_id") > 5).count() == 0
    assert vt.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_larger_factors_look_at_less_and_keep_recall():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 8))
    x = centres[rng.integers(40, size=6000)] + 0.15 * rng.standard_normal((6000, 8))
    tree = vt.build(np.arange(6000), x, 6)
    asked = np.arange(0, 6000, 50)
    full = vt.unit(x[asked]) @ vt.unit(x).T
    full[np.arange(len(asked)), asked] = -9
    truth = np.argsort(-full, axis=1)[:, :5]
    share, recall = [], []
    for factor in (1.0, 1.5, 3.0):
        best = vt.Best(asked, x[asked], 5)
        share.append(vt.search(tree, best, factor) / (len(asked) * len(x)))
        recall.append(np.mean([len(set(a) & set(b)) / 5 for a, b in zip(best.row, truth)]))
    assert recall[0] == 1.0 and recall[1] >= 0.9
    assert share[0] < 0.3 and share[2] < share[1] < share[0]


# ---- conversation repair ------------------------------------------------------------------

AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute_repair(rows):
    """Cheapest edits by best-first search over (cost, edits so far) of one conversation's ``(turn, role, text)``."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda g: (g[0] is not None, g[0] or 0, g[1], g[2]))
    turns = [t for t, _, _ in rows if t is not None]
    faults, seen = [], set()
    for _, r, x in rows:
        s = x.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not s else "duplicate" if (r, x) in seen else "none" if s[-1] in ".!?" else "truncated")
        seen.add((r, x))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in ("user", "assistant"):
            if role[0] in AFTER[state]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*out, (role, ""))))
        if i < len(rows):
            _, r, x = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] in ("none", "truncated"):
                more = faults[i] == "truncated"
                if r and r[0] in AFTER[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, r[0], (*out, (r, x))))
                for role in ("user", "assistant"):
                    if role[0] in AFTER[state]:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, role[0], (*out, (role, x))))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def chats(seed, n, longest):
    rng = random.Random(seed)
    return {c: [(rng.choice([None, k, k, k, k + 1]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"]),
                 rng.choice(["Yes.", "No", " ", "", None, "Why?\n", "text " * 3, "é!", "..."])) for k in range(rng.randint(1, longest))] for c in range(n)}


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("kw", [{}, {"chunk_rows": 2}, {"chunk_chars": 9, "rules": 2}, {"rules": 0, "chunk_rows": 5}])
def test_repair_matches_search(spark, kw):
    convs = chats(5, 120, 9) | {None: [(0, "user", "Hi."), (1, "assistant", "Ho.")]}
    df = spark.createDataFrame([(c, *r, "x") for c, rows in convs.items() for r in rows], "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: tuple(r[n] for n in RESULT) for r in cr.repair(df, **kw).collect()}
    assert got == {c: brute_repair(rows) for c, rows in convs.items()}


def test_long_conversation_and_repaired_rows(spark):
    convs = chats(6, 1, 400) | {1: [(0, "assistant", "A."), (3, "assistant", "A.")]}
    df = spark.createDataFrame([(c, *r) for c, rows in convs.items() for r in rows], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: tuple(r[n] for n in RESULT) for r in cr.repair(df, chunk_rows=7).collect()}
    assert got == {c: brute_repair(rows) for c, rows in convs.items()}
    rows = cr.repaired_turns(df, chunk_rows=7).orderBy("conv_id", "position").collect()
    for c in convs:
        of = [r for r in rows if r["conv_id"] == c]
        assert [r["position"] for r in of] == list(range(len(of)))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in of).encode()).hexdigest() == got[c][-1]
    assert [r["edit"] for r in rows if r["conv_id"] == 1] == ["I", "K"]


def test_rules_are_shared_and_their_matrices_equal_plain_products():
    rng = random.Random(7)
    plain = [cr.symbol(r, f) for r in ("s", "u", "a", "") for f in cr.FAULTS]
    grammar = cr.Grammar([plain[4] + plain[8], chr(cr.RULE) + chr(cr.RULE), plain[7] + plain[8]])
    for _ in range(50):
        s = "".join(rng.choice(plain[4:9]) for _ in range(rng.randint(1, 40)))
        want = cr.Grammar([])
        assert grammar.edits(s) == want.edits(s)
        a, b = grammar.chunk(s), want.chunk(s)
        assert {k: (v[0], cr.flat(v[2])) for k, v in a.items()} == {k: (v[0], cr.flat(v[2])) for k, v in b.items()}


def test_dropped_rows_leave_their_conversation(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", True), (2, 0, "user", "Hi.", False), (2, 4, "x", None, True)], "conv_id int, turn int, role string, text string, gone boolean")
    got = {r["conv_id"]: tuple(r[n] for n in RESULT) for r in cr.repair(df, gone="gone").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[2] == brute_repair([(0, "user", "Hi.")])
    assert cr.repair(df.limit(0), gone="gone").count() == 0
    assert cr.repaired_turns(df.limit(0), gone="gone").count() == 0


@pytest.mark.parametrize("name", ["op11_spelling_forms", "op12_vantage_neighbours", "op13_conversation_repair"])
def test_plans_hold_no_cross_join(spark, name):
    plan = q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SinglePartition" not in plan
