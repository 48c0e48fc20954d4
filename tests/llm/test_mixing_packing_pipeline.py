"""Source mixing, packing and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemill.llm import mixing, packing
from tidemill.llm.queries import op5_pack_documents, op8_mix_sources, tokenizer_path

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(w[s] for s in rest)) if rest else 0
        over = [s for s in rest if share * w[s] > epochs * sizes[s]]
        if not over:
            return {**fixed, **{s: share * w[s] for s in rest}}
        fixed |= {s: epochs * sizes[s] for s in over}


def mix_rows():
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), f"s{int(rng.integers(0, 6))}") for i in range(200)]
    return rows + [(300, "one  two\tthree\n", "Zed"), (301, None, "s1"), (302, " \n ", "empty source"), (303, "a b", None), (303, "a b", None), (None, "c d e", None), (304, "x " * 5000, "é"), (305, "x " * 9, "é")]


def test_mix_takes_every_target_and_repeats_rows_at_most_three_times(spark):
    rows = mix_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    plan, takes = mixing.mix(df, block_words=16)
    plan, takes = plan.toPandas(), takes.toPandas()
    size = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    want = brute_targets(size)
    assert len(plan) == len(rows)
    taken = takes.groupby("_rid").words.sum()
    plan["taken"] = plan["_rid"].map(taken).fillna(0)
    for s, g in plan.groupby(plan.source.where(plan.source.notna(), None), dropna=False):
        s = s if isinstance(s, str) else None
        assert g.source_size.iloc[0] == size[s] and g.target.iloc[0] == pytest.approx(want[s])
        assert g.taken.sum() == round(want[s])
    assert (plan.taken <= 3 * plan["size"]).all()
    assert sorted(takes.slot.unique()) == sorted(set(takes.slot)) and takes.words.min() > 0
    # every word of a pass is taken at most once, and passes follow each other
    for _, g in takes.sort_values("first").groupby(["_rid", "epoch"]):
        assert (g["first"].to_numpy()[1:] >= (g["first"] + g.words).to_numpy()[:-1]).all()


def test_schedule_interleaves_sources_evenly(spark):
    """Any prefix of the schedule holds every source near its share."""
    df = spark.createDataFrame([(i, "w " * 40, f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    plan, takes = mixing.mix(df, block_words=8)
    t = takes.join(plan.select("_rid", "source", "target"), "_rid").toPandas().drop_duplicates(["slot", "source"]).sort_values("slot")
    share = {s: g.target.iloc[0] / 12000 for s, g in t.groupby("source")}
    for n in (50, 200, 700, 1400):
        head = t[t.slot < n]
        for s, p in share.items():
            assert abs((head.source == s).sum() - n * p) <= 4


def test_mix_does_not_depend_on_run_length_and_is_repeatable(spark, monkeypatch):
    df = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    a = sorted(map(tuple, mixing.mix(df)[1].collect()))
    assert a == sorted(map(tuple, mixing.mix(df)[1].collect()))
    monkeypatch.setattr(mixing, "RUN_ROWS", 7)
    plan, takes = mixing.mix(df)
    got = {r["source"]: (r["t"], r["n"]) for r in plan.join(takes.groupBy("_rid").agg(F.sum("words").alias("w")), "_rid", "left").groupBy("source").agg(F.first("target").alias("t"), F.sum("w").alias("n")).collect()}
    assert all((n or 0) == round(t) for t, n in got.values())


def test_mixed_documents_hold_what_was_taken(spark):
    df = spark.createDataFrame([(*r, "k") for r in mix_rows()], "doc_id long, text string, source string, size string")
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    plan, takes = mixing.mix(df)
    assert out.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0] == takes.agg(F.sum("words")).first()[0]
    assert mixing.mix_documents(df.limit(0)).count() == 0


def test_mix_query_reaches_its_targets(spark):
    q = op8_mix_sources(spark, SF).toPandas()
    src = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").toPandas()
    for _, g in q.merge(src, on="doc_id").groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1


WEIRD = ["It's we'd they'll I've 'tis ''s 'sm x're \"'s", "ÀÉÎ straße × ÷ ÿ", "ελληνικά Σίσυφος ΣΑΣ", "日本語 text", "á é", "12 3.14 1,000", "tab\tnew\nline\r\n  ", "<|endoftext|> x <|startoftext|>",
         "İstanbul", "\x00\x1f ctrl\x85nel\xa0nbsp", "emoji \U0001F600!", "", "   ", "word" * 3000, "!!!???'''", "don't can't won't'd", "'", "x '", "'s", "a'ſ"]


def test_ids_equal_the_tokenizer(monkeypatch):
    tok, enc = Tokenizer.from_file(tokenizer_path()), packing.WordEncoder(tokenizer_path())
    for _ in range(2):
        for t, ids in zip(WEIRD, enc.encode(WEIRD)):
            assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    monkeypatch.setattr(packing, "PART_CHARS", 40)
    long = " ".join(WEIRD[:5]) * 5
    assert enc.encode([long, "x"])[0].tolist() == tok.encode(long, add_special_tokens=False).ids


def check_packing(out, limit):
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() <= limit


def test_packing_query_covers_every_id_once(spark):
    tok = Tokenizer.from_file(tokenizer_path())
    out = op5_pack_documents(spark, SF).toPandas()
    check_packing(out, 4096)
    n = out.groupby("sequence_id").length.sum()
    assert 1 - n.sum() / (4096 * len(n)) < 0.02
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    for d in docs:
        ids = np.array(tok.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        g = out[out.doc_id == d["doc_id"]].sort_values("start")
        assert g.start.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() == len(ids) == g.doc_tokens.iloc[0]
        assert [zlib.crc32(ids[s:s + k].tobytes()) for s, k in zip(g.start, g.length)] == g.ids_crc32.tolist()


def test_packing_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "same"), (3, "same"), (4, "word " * 30000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, length string")
    out = packing.pack_documents(df, tokenizer_path(), max_tokens=4096).toPandas()
    check_packing(out, 4096)
    assert out[out.doc_id == 1].length.tolist() == [1] and len(out[out.doc_id == 3]) == 2 and out[out.doc_id == 4].length.sum() == 30001
    assert packing.pack_documents(df.limit(0), tokenizer_path()).count() == 0


def test_limits_hold_together(spark):
    rng = np.random.default_rng(1)
    rows = [(int(t), int(rng.integers(0, t + 1)), i) for i, t in enumerate(rng.integers(1, 101, 3000))]
    df = spark.createDataFrame(rows, "length long, loss long, id long")
    out = packing.pack(df, 100, 4, 60, group_pieces=1000) if all(r[1] <= 60 for r in rows) else packing.pack(df.where("loss <= 60"), 100, 4, 60, group_pieces=1000)
    g = out.toPandas().groupby("sequence_id").agg(t=("length", "sum"), n=("length", "size"), l=("loss", "sum"))
    assert g.t.max() <= 100 and g.n.max() <= 4 and g.l.max() <= 60
    with pytest.raises(Exception, match="exceeds the limits"):
        packing.pack(df, 50).count()


def test_dot_product_choice_fills_by_the_scarcest_room():
    demand = np.array([[6, 1, 0], [4, 1, 4], [4, 1, 0], [5, 1, 5], [1, 1, 1]])
    bins, place = packing.dot_product_pack(demand, np.array([10, 3, 5]))
    # opens with the largest demand on all limits, then what still fits and demands most
    assert bins[3] == 0 and place[3] == 0 and bins[2] == 0 and place[2] == 1


def test_pipeline_stages_chain_and_take_effect(spark):
    from tidemill.llm._shared import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.columns
    extra = spark.createDataFrame([(90001, "... 123 !!!", "en", "src0", 11), (90002, None, "en", "src0", 0), (90003, docs.first()["text"], "en", "src1", 5)], docs.schema)
    # two copies of one text on other lines: no line is like another, their shingles are
    words = " ".join(r["text"] for r in docs.where("lang = 'en'").orderBy("doc_id").limit(5).collect()).split()
    words = [words[i] for i in np.random.default_rng(4).permutation(len(words))[:240]]
    cut = lambda n: "\n".join(" ".join(words[i:i + n]) for i in range(0, len(words), n))
    extra = extra.unionByName(spark.createDataFrame([(90004, cut(240), "en", "src0", 9), (90005, cut(11), "en", "src1", 9)], docs.schema))
    docs = materialize(docs.unionByName(extra), "test")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == first
        seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert not seen["language_id"] & {90001, 90002}
    assert {90004, 90005} <= seen["line_dedup"]
    assert len(seen["near_dedup"]) < len(seen["line_dedup"])
    assert len({90004, 90005} & seen["near_dedup"]) == 1
    assert seen["mix_sources"] <= seen["near_dedup"]
    out = materialize(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "packed").toPandas()
    check_packing(out, 4096)
    assert set(out.doc_id) == seen["mix_sources"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix_sources", "pack_sequences"]
