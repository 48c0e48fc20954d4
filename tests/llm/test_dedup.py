"""Exact, line and near-duplicate operators against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemill.llm import exact_dedup, fuzzy_lines, weighted_minhash as wm
from tidemill.llm._shared import with_row_id
from tidemill.llm.graph import components

DOCS = "doc_id long, text string, kept string, _rid string"


def squeeze(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, (k, t) in enumerate(rows):
        groups[squeeze(t)].append((k is None, k if k is not None else 0, i))
    out = []
    for t, g in groups.items():
        first = min(g)
        for none, k, i in g:
            out.append((None if none else k, None if first[0] else first[1], len(g), i == first[2], hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def run_exact(spark, rows):
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], DOCS)
    return Counter(tuple(r) for r in exact_dedup.exact_groups(df).collect())


def test_exact_groups_edge_cases(spark):
    base = "é" * 40 + " tail"
    rows = [(1, None), (2, ""), (3, "a  b"), (4, "a\tb"), (4, "a b"), (None, "a b"), (5, base), (6, base), (7, base + "x"), (8, base[:-1]),
            (9, "z" * 64), (10, "z" * 64), (11, "z" * 65), (12, "q" * 70000), (13, "q" * 70000), (14, "q" * 69999 + "r"), (None, "only"), (None, "only"),
            (20, "w" * 576), (21, "w" * 576), (22, "w" * 575), (3, "a  b")]
    assert run_exact(spark, rows) == brute_exact(rows)


def test_exact_groups_empty_table(spark):
    assert run_exact(spark, []) == Counter()


def test_row_numbers_do_not_follow_the_cut_of_files(spark, tmp_path):
    spark.range(4000).selectExpr("id", "id AS _metadata", "'x' AS _rid").repartition(16).write.parquet(str(tmp_path / "t"))
    t = lambda: with_row_id(spark.read.parquet(str(tmp_path / "t")).where("id > 5").select("id", "_rid", "_metadata"))
    seen = []
    for size in ("128m", "20k", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1" if size == "20k" else "4m")
        seen.append(sorted((r["id"], r["_rid"]) for r in t().collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] == seen[2] and len({n for _, n in seen[0]}) == 3994
    assert t().columns == ["id", "_metadata", "_rid"]


def test_components_are_connected_sets(spark):
    edges = [(1, 2), (2, 3), (9, 8), (7, 8), (20, 21), (5, 5)] + [(i, i + 1) for i in range(100, 130)] + [(30, i) for i in range(31, 60)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20, **{i: 100 for i in range(100, 131)}, **{i: 30 for i in range(30, 60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(spark, rows, min_words=5):
    """Drops by all pairs; SimHashes come from the same word hashes, counted one bit at a time."""
    occ = []
    for i, (k, t) in enumerate(rows):
        for n, line in enumerate((t if t is not None else "").split("\n") if t is not None else []):
            norm = re.sub(r"[^\w]+|_+", " ", line.lower()).strip()
            if len(norm.split()) >= min_words:
                occ.append((k is None, k or 0, i, n, norm))
    words = sorted({w for o in occ for w in o[4].split()})
    hashes = {r[0]: r[1] for r in spark.createDataFrame([(w,) for w in words] or [("a",)], "w string").selectExpr("w", "xxhash64(w)").collect()}

    def sim(norm):
        ws = norm.split()
        return [2 * sum(hashes[w] >> b & 1 for w in ws) > len(ws) for b in range(64)]

    norms = sorted({o[4] for o in occ})
    sims, parent = {x: sim(x) for x in norms}, {x: x for x in norms}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(norms):
        for b in norms[:i]:
            if sum(x != y for x, y in zip(sims[a], sims[b])) <= 3 and 1 - levenshtein(a.split(), b.split()) / max(len(a.split()), len(b.split())) >= 0.8:
                parent[root(a)] = root(b)
    best = {}
    for o in occ:
        best[root(o[4])] = min(best.get(root(o[4]), o[:4]), o[:4])
    drop = defaultdict(set)
    for o in occ:
        if best[root(o[4])] != o[:4]:
            drop[o[2]].add(o[3])
    return [(k, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in drop[i]) if drop[i] else t, len(drop[i])) for i, (k, t) in enumerate(rows)]


LONG = "the quick brown fox jumps over the lazy dog while nine more foxes watch from the old red barn near the river bank today and they all stay quiet until the evening comes"


def line_rows():
    near = LONG.replace("quiet", "quiets")
    return [(5, LONG + "\nfirst line of its own here now"), (2, LONG.upper() + "!!\nshort one"), (3, near), (4, "other words entirely in this line\n\n\nshort one"),
            (None, LONG), (7, None), (8, ""), (9, "short one\nshort one"), (3, near), (10, "other words entirely in this line"), (11, "a b c d e\na b c d e\na, b; c: d e!"),
            (12, "\n".join([LONG + " " + "word " * 3000, "x y z x y z"]))]


def test_fuzzy_lines_match_brute_force(spark):
    rows = line_rows()
    df = spark.createDataFrame([(k, t, "extra", 3) for k, t in rows], "doc_id long, text string, lines_dropped string, _rid int")
    out = fuzzy_lines.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "_rid", "lines_total", "lines_dropped"]
    key = lambda x: (str(x[0]), str(x[1]), x[2])
    got = sorted(((r["doc_id"], r["text"], r["lines_dropped"]) for r in out.collect()), key=key)
    want = sorted(brute_lines(spark, rows), key=key)
    assert got == want
    assert any(d for *_, d in want)


def edited_lines():
    """Lines and copies with as many edits as the similarity allows, or one more."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(120):
        n = int(rng.integers(5, 45))
        base = [f"w{k}{'x' * int(rng.integers(6))}{rng.integers(12)}" for _ in range(n)]
        rows.append(base)
        for _ in range(3):
            copy = list(base)
            for _ in range(n // 5 + int(rng.integers(-1, 2))):
                i = int(rng.integers(len(copy)))
                copy[i:i + int(rng.integers(2))] = [f"e{rng.integers(1 << 30)}"] * int(rng.integers(2))
            rows.append(copy)
    return [" ".join(r) for r in rows if len(r) >= 5]


def test_fuzzy_lines_find_every_link_of_edit_similarity_alone(spark):
    lines = edited_lines()
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            longer = max(len(a.split()), len(b.split()))
            if abs(len(a.split()) - len(b.split())) * 5 <= longer and levenshtein(a.split(), b.split()) * 5 <= longer:
                parent[max(root(i), root(j))] = min(root(i), root(j))
                links += 1
    got = fuzzy_lines.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), max_bits=None).collect()
    assert links > 100
    assert {r["doc_id"] for r in got if r["lines_dropped"] == 0} == {i for i in range(len(lines)) if root(i) == i}


def test_fuzzy_lines_whose_pairs_repeat_and_large_groups(spark):
    """A pair that a line holds twice links at either place; copies of one line with different edits, and copies of two lines that
    share most pairs, form their own groups."""
    rng = np.random.default_rng(5)
    long = "extraordinarily longwindedness"
    lines = [f"{long} a b c d e f g h {long} i j", f"a b c d e f g h {long} i j", f"k l {long} m n o p q r s t {long}", f"k l m n o p q r s t {long}"]
    for k in range(2):
        base = [f"shared{i}" for i in range(14)] + [f"own{k}x{i}" for i in range(12)]
        for i in range(60):
            copy = list(base)
            copy[int(rng.integers(26))] = f"edit{k}x{i}"
            lines.append(" ".join(copy))
    words = [x.split() for x in lines]
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(words):
        for j, b in enumerate(words[:i]):
            if levenshtein(a, b) * 5 <= max(len(a), len(b)):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    got = fuzzy_lines.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), max_bits=None).collect()
    assert {r["doc_id"] for r in got if r["lines_dropped"] == 0} == {i for i in range(len(lines)) if root(i) == i}
    assert {root(i) for i in range(4, len(lines))} == {4, 64}


def test_fuzzy_lines_of_few_words_and_of_scripts_without_spaces(spark):
    chinese, thai = "本站所有内容均由用户自行上传发布", "สงวนลขสทธตามกฎหมายหามคดลอก"
    rows = [(1, f"Share on Facebook\n{chinese}\n\n- -"), (2, f"share on facebook!\n{chinese.replace('用', '客')}\n\n- -"),
            (3, f"Share on Twitter\n{thai}\n二〇二四"), (4, f"{thai}\n二〇二四\n二〇二五"), (5, f"{chinese[::-1]}\n{chinese}")]
    out = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), max_bits=None, short_lines=True)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: rows[0][1], 2: "\n- -", 3: rows[2][1], 4: "二〇二五", 5: chinese[::-1]}


def test_fuzzy_lines_of_a_common_passage_do_not_meet(spark, monkeypatch):
    """Lines that share a passage of long words but are no copies send no key that they share."""
    rng, rows, store = np.random.default_rng(3), [], fuzzy_lines.materialize
    for i in range(400):
        words = [f"w{i:03d}x{j:02d}" for j in range(17)]
        at = int(rng.integers(0, 18))
        rows.append((i, " ".join([*words[:at], "extraordinarily", "comprehensive", "explanations", *words[at:]])))
    stored = []

    def spy(df, name, *args):
        out = store(df, name, *args)
        stored.append((name, out.count()))
        return out

    monkeypatch.setattr(fuzzy_lines, "materialize", spy)
    out = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), max_bits=None).collect()
    assert sum(r["lines_dropped"] for r in out) == 0
    assert sum(n for name, n in stored if name == "line-probes") < 100


def test_word_ranks_count_every_line(spark):
    """A word that stands in a few lines of a large table only ranks by all of them."""
    lines = spark.range(400_000).selectExpr("concat_ws(' ', concat('a', id), concat('b', id), concat('c', id), concat('d', id), concat('e', id)) AS _spaced")
    rare = [f"once x{i} y{i} z{i} v{i}" for i in range(400)]
    lost = [r[0] for r in spark.createDataFrame([(x,) for x in rare], "_spaced string").where("pmod(xxhash64(_spaced), 3) <> 0").collect()]
    slot = spark.sql(f"SELECT xxhash64('once') & {fuzzy_lines.RANK_SLOTS - 1}").first()[0]
    ranks = fuzzy_lines.word_ranks(lines.unionAll(spark.createDataFrame([(x,) for x in lost], "_spaced string")))
    assert ranks[slot] > 0


def test_fuzzy_lines_with_all_edits_allowed(spark):
    """Lines about the lengths at which the number of buckets changes, with words that stand several times."""
    rng, rows = np.random.default_rng(11), []
    for k, n in enumerate(n for n in (5, 9, 10, 14, 15, 16, 18, 19, 20, 60, 74, 75, 76, 90, 94, 95, 330) for _ in range(4)):
        words = [f"k{k}v{rng.integers(0, max(3, n // 2))}" if rng.random() < 0.5 else ["of", "the", "and"][rng.integers(0, 3)] for _ in range(n)]
        copy = list(words)
        ops = rng.choice(3, n // 5, p=[[1, 0, 0], [0, 1, 0], [0, 0, 1], [0.4, 0.3, 0.3]][k % 4])
        for op in ops:
            at = int(rng.integers(0, len(copy)))
            copy[at:at + (op != 2)] = [] if op == 1 and len(copy) > 5 else [f"new{rng.integers(0, 10 ** 9)}"]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    out = fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), max_bits=None).collect()
    assert {r["doc_id"] for r in out if r["lines_dropped"]} >= {k for k, _ in rows if k % 2}


def test_fuzzy_lines_empty_table(spark):
    assert fuzzy_lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_block_masks_cover_all_close_hashes():
    rng = np.random.default_rng(0)
    for lines in (10, 1 << 24, 1 << 33):
        masks = fuzzy_lines.block_masks(lines)
        for _ in range(300):
            flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any(flips & m == 0 for m in masks)
    assert len(fuzzy_lines.block_masks(10)) < len(fuzzy_lines.block_masks(1 << 24)) < len(fuzzy_lines.block_masks(1 << 33))


def brute_classes(rows, share=wm.RARE_SHARE):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\W_]+", (t or "").lower())
        sets.append(Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter())
    n, df = len(rows), Counter(s for x in sets for s in x)
    weight = [{s: c * np.log1p(n / max(df[s], share * n)) for s, c in x.items()} for x in sets]
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if weight[i] and weight[j]:
                both = sum(min(w, weight[j].get(s, 0)) for s, w in weight[i].items())
                if both / (sum(weight[i].values()) + sum(weight[j].values()) - both) >= 0.8:
                    parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(n):
        groups[root(i)].append((rows[i][0] is None, rows[i][0] or 0, i))
    return Counter((rows[i][0], None if min(g)[0] else min(g)[1], len(g), i == min(g)[2]) for g in groups.values() for _, _, i in g)


def near_rows():
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    rows = []
    for k in range(25):
        words = list(rng.choice(vocab, 150))
        rows.append((k, " ".join(words)))
        for c in range(k % 4):
            other = list(words)
            other[int(rng.integers(150))] = f"edit{k}x{c}"
            rows.append((100 + 10 * k + c, " ".join(other)))
    return rows + [(500, None), (501, ""), (502, "..."), (503, "one two"), (504, "One, two!"), (None, "one two"), (505, "word " * 3000), (506, "word " * 3000), (0, rows[0][1])]


def test_near_classes_match_brute_force(spark, tmp_path):
    rows = near_rows()
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, kept int, _rid int").repartition(3)
    df.write.parquet(str(tmp_path / "docs"))
    got = Counter(tuple(r) for r in wm.near_classes(spark.read.parquet(str(tmp_path / "docs"))).drop("_rid").collect())
    want = brute_classes(rows)
    # a repeated id has one kept row, whichever of its equal rows that is
    strip = lambda c: Counter({k: v for k, v in c.items() if k[0] != 0})
    assert strip(got) == strip(want)
    assert sum(v for k, v in got.items() if k[3]) == sum(v for k, v in want.items() if k[3])


def test_near_classes_of_one_large_group(spark):
    """A dense group of near copies is one class; its pairs are not all compared."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(150)]
    got = wm.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["class_id"], r["class_size"]) for r in got} == {(0, 150)}


def test_rare_shingles_weigh_by_their_exact_counts(spark, tmp_path):
    """Documents that share a passage which ten of 1,200 hold: alike if all rare shingles weighed the same, apart by their counts."""
    passage = " ".join(f"p{i}" for i in range(404))
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(45))) for i in range(10)]
    rows += [(i, " ".join(f"o{i}x{j}" for j in range(8))) for i in range(10, 1200)]
    rows += [(2000, rows[3][1].replace("own3x30", "edited"))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    got = wm.near_classes(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {**{k: k for k, _ in rows}, 2000: 3}


def test_shingles_are_counted_over_chunks_and_slots(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 3, int(rng.integers(0, 30)))) for _ in range(300)] + ["common words that stand in all"] * 40
    rows = [(i, t or None) for i, t in enumerate(texts)]
    want = Counter(k for t in texts for k in set(wm.all_shingles([t])[1].tolist()))
    plain = spark.createDataFrame(rows, "_rid long, _text string").repartition(5)
    monkeypatch.setattr(wm, "TEXT_CHARS", 400)
    shared = spark.sparkContext.broadcast(wm.common_shingles(plain.select("_text"), "_text", 0.1))
    assert 0 < len(shared.value[0]) < len(want)
    got = wm.rare_counts(plain, shared, 4, 3).collect()
    weights = wm.Weights(*shared.value[:3])
    for chunk in range(len(rows) // 16 + 1):
        mine = [r for r in got if r["_chunk"] == chunk]
        keys = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(r["_keys"], np.uint64) for r in mine]])
        n = np.concatenate([np.empty(0, np.int64), *[wm.unpacked_counts(r["_counts"]) for r in mine]])
        order = np.argsort(keys)
        held = np.unique(wm.all_shingles(texts[16 * chunk:16 * chunk + 16])[1])
        assert weights.documents_of(held, keys[order], n[order]).tolist() == [want[k] for k in held.tolist()]


def test_near_classes_do_not_follow_chunks(spark, monkeypatch, tmp_path):
    spark.createDataFrame(near_rows(), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    found = lambda: Counter(tuple(r) for r in wm.near_classes(spark.read.parquet(str(tmp_path / "docs"))).collect())
    want = found()
    monkeypatch.setattr(wm, "TEXT_CHARS", 1000)
    monkeypatch.setattr(wm, "SLOT_SHINGLES", 500)
    assert found() == want


def test_near_classes_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert wm.near_classes(df).count() == 0
    assert wm.keep_one(df).count() == 0


def test_samples_agree_as_often_as_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    keys.sort()
    a, b = rng.uniform(1, 8, 300), rng.uniform(1, 8, 300)
    want = wm.similarity(keys, a, keys, b)
    n = 4000
    _, x, _ = wm.band_keys(np.zeros(300, int), keys, a, 1, n, 1)
    _, y, _ = wm.band_keys(np.zeros(300, int), keys, b, 1, n, 1)
    assert (x == y).mean() == pytest.approx(want, abs=0.03)


def test_common_shingles_are_counted_exactly(spark):
    rows = [(f"boiler plate text of five words and more unique{i} token{i} here{i}",) for i in range(300)] + [(f"alone{i} b{i} c{i} d{i} e{i}",) for i in range(300)]
    df = spark.createDataFrame(rows, "text string").repartition(7)
    keys, counts, n, _ = wm.common_shingles(df, "text", 0.01)
    assert n == 600 and len(keys) == 4 and set(counts) == {300.0}


def test_many_candidates_for_common_shingles_stay_in_spark(spark, monkeypatch):
    """Runs of few documents hide much, so every shingle of a copied document becomes a candidate."""
    rows = [(f"boiler plate text of five words and more unique{i // 2} token{i // 2} here{i // 2}",) for i in range(400)]
    df = spark.createDataFrame(rows, "text string").repartition(20)
    want = wm.common_shingles(df, "text", 0.01)
    monkeypatch.setattr(wm, "HANDED_SHINGLES", 3)
    got = wm.common_shingles(df, "text", 0.01)
    assert sorted(zip(got[0], got[1])) == sorted(zip(want[0], want[1]))
    assert got[2] == 400 and len(got[0]) == 4 and set(got[1]) == {400.0}
