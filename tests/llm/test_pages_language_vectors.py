"""Page text, language identification and vector links."""

import html
import re

import numpy as np
import pytest

from tidemill.llm import crf_langid as lid
from tidemill.llm import html_main as hm
from tidemill.llm import subspace_join as sj

SF = "/root/testdata/sf0.001"
P1 = "A first paragraph, with commas, and enough words to count as text."
P2 = "A second one, of the same kind, so that the container wins."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>x='<p>no, no, no</p>'</script></head><body>{body}</body></html>"


@pytest.mark.parametrize("body, want", [
    (f"<nav><a href=x>Home</a></nav><article><h1>Head</h1><p>{P1}<p>{P2}</article><footer>foot, foot</footer>", f"Head {P1} {P2}"),
    (f"<div id=header>Site, site, site</div><div class='post-content'><p>{P1}</p><p>{P2}</p></div><div class=comments><p>{P1} {P1} {P1}</p></div>", f"{P1} {P2}"),
    (f"<article><p>{P1}</p><aside>Aside, aside</aside><form><p>Name, mail</p><button>Go</button></form><p>{P2}</p></article>", f"{P1} {P2}"),
    (f"<article><p>{P1}</p><div class='ad'>Buy, buy, buy</div><ul><li>one<li>two</ul><section class='comments'><p>{P2}</p></section></article>", f"{P1} one two"),
    (f"<article><p>a &lt;b&gt; &amp;amp; &#233;&nbsp;&#x1F600; &copy {P1}</p></article>", f"a <b> &amp; é \U0001F600 © {P1}"),
    (f"<article><p>one<br>two   three\n four <b>bo</b>ld</p><p>{P1}</p></article>", f"one two three four bold {P1}"),
    (f"<main><header><h1>Inside head</h1></header><p>{P1}</p></main><header>Outside, head</header>", f"Inside head {P1}"),
    (f"<article><p>{P1}</p><style>p{{a,b,c}}</style><!-- c, c, c --><noscript>No, js</noscript><p style='display:none'>hidden, text</p></article>", P1),
    ("<nav><a href=x>only</a> <a href=y>links</a></nav>", ""),
    ("<ul><li><a href=a>x</a><li><a href=b>y</a></ul>", ""),
    (f"<div><section>{f'<p>{P1}</p>' * 20}</section><section><h2>Conclusion</h2><p>short end.</p></section></div>", " ".join([P1] * 20) + " Conclusion short end."),
    (f"<div>Before it.<div><p>{P1}</p><p>{P2}</p></div>After <b>it</b>.</div>", f"Before it. {P1} {P2} After it."),
    (f"<div><div><p>{P1}</p><p>{P2}</p></div><table><tr><td>1</td><td>2</td></tr></table></div>", f"{P1} {P2} 1 2"),
    (f"<div><div><div><p>{P1}</p><p>{P2}</p></div></div><p>Last words.</p></div>", f"{P1} {P2} Last words."),
    (f"<div><div><p>{P1}</p><p>{P2}</p></div><a href=x>Next</a><ul><li><a href=a>One</a><li><a href=b>Two</a></ul><section class=related><p>{P1}</p></section></div>", f"{P1} {P2}"),
])
def test_main_text(body, want):
    assert hm.main_text(page(body)) == want


def test_broken_markup_does_not_crash():
    for x in ("", " ", "plain, text", "<", "<p", "<p><p", "</div></p>x, y, z", "<script>never closed", "<!-- never closed <p>x", "<a href='x>q</a><p>t, t, t", "<p a=\"1\" a='2' b=3 c>ok, ok</p>", "<div>" * 3000 + "deep, deep", "<table><tr><td>a, b<td>c<tr><td>d</table>"):
        assert isinstance(hm.main_text(x), str)
    assert hm.main_text("plain, text") == "plain, text"


def test_given_pages_give_their_article(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in hm.extract_pages(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:h1|p)>|<br>", " ", inner))).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


def test_pages_with_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, None, "a"), (None, "u", page(f"<p>{P1}</p>"), "b"), (1, None, None, "a")], "page_id long, url string, html string, text string")
    assert sorted((tuple(r) for r in hm.extract_pages(df).collect()), key=str) == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", P1, len(P1))], key=str)
    assert hm.extract_pages(df.limit(0)).count() == 0


# --- language identification

def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    score, step, start = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    chain = np.array([0, 0, 0, 0, 1, 2, 2, 2, 3])
    got, moves = lid.forward_backward(score, chain, step, start, moves=True)
    want, want_moves = np.zeros((9, 3)), np.zeros((3, 3))
    for c in range(4):
        rows = np.flatnonzero(chain == c)
        total = 0.0
        m, t = np.zeros((len(rows), 3)), np.zeros((3, 3))
        for path in np.ndindex(*[3] * len(rows)):
            p = np.exp(start[path[0]] + sum(score[r, k] for r, k in zip(rows, path)) + sum(step[a, b] for a, b in zip(path, path[1:])))
            total += p
            for i, k in enumerate(path):
                m[i, k] += p
            for a, b in zip(path, path[1:]):
                t[a, b] += p
        want[rows] = m / total
        want_moves += t / total
    assert np.allclose(got, want) and np.allclose(moves, want_moves)


def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-1, None, "en"), (-2, "123 ... !?", "en"), (None, "The thing and that", None), (-3, "", None)], docs.schema)
    out = lid.identify(docs.unionByName(extra).withColumn("lang_pred", docs.lang)).collect()
    assert len(out) == docs.count() + 4
    by = {r["doc_id"]: r for r in out}
    assert all((by[k]["lang_pred"], by[k]["lang_score"]) == ("und", 0.0) for k in (-1, -2, -3)) and by[None]["lang_pred"] == "en"
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] >= 0 and lid.crc_of(r["doc_id"]) % 4 == 2 and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["lang_score"] <= 1 for r in out)


def test_code_switched_words_are_labelled_one_by_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    field = lid.train(lid.sample_lines(docs, "doc_id", "text", "lang", 60, 200))
    words, m = field.marginals(["the thing and that with from der schen und lichkeit auf nicht les queaux étre ment dans"])
    assert [field.labels[k] for k in m.argmax(1)] == ["en"] * 6 + ["de"] * 6 + ["fr"] * 5


def test_no_labels_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["lang_score"]) for r in lid.identify(df).collect()} == {("und", 0.0)}
    assert lid.identify(df.limit(0)).count() == 0
    one = spark.createDataFrame([(i, "some text", "xx") for i in range(9)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in lid.identify(one).collect()} == {"xx"}


# --- vectors

def brute_links(rows, least=0.93):
    n = len(rows)
    ok = [r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    first = {}
    for i, r in enumerate(rows):
        k = (r[0] is None, r[0] or 0)
        first[root(i)] = min(first.get(root(i), k), k)
    return sorted(((r[0], links[i], None if first[root(i)][0] else first[root(i)][1]) for i, r in enumerate(rows)), key=str)


def vector_rows():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            v = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 5))):
                rows.append((k, (v + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25, 0.35])).astype(np.float32).tolist(), label))
                k += 1
    dense = rng.normal(size=16)
    rows += [(1000 + i, (dense + rng.normal(size=16) * 0.2).astype(np.float32).tolist(), 1) for i in range(60)]
    return rows + [(2000, [0.0] * 16, 0), (2001, None, 0), (2002, [1.0, float("nan")] + [0.0] * 14, 0), (2003, [1.0, None] + [0.0] * 14, 0), (2004, [], 0), (2005, [float("inf")] * 16, 0),
                   (None, rows[0][1], 0), (2006, [1.0, -0.0], 0), (2007, [2.0, 0.0], 0), (2007, [2.0, 0.0], 0), (2008, [1.0, 0.0], 0)]


@pytest.mark.parametrize("task, cell", [(2048, 8192), (16, 8192), (2048, 20), (16, 20)])
def test_links_match_brute_force_however_work_is_cut(spark, task, cell):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, label int, kept int")
    out = sj.near_vectors(df, task_vectors=task, cell_vectors=cell).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute_links(rows)
    heads = {}
    for r in out:
        if r["kept"]:
            assert r["vec_id"] == r["component_id"]
            heads[r["component_id"]] = heads.get(r["component_id"], 0) + 1
    assert set(heads) >= {r["component_id"] for r in out if r["component_id"] is not None}


@pytest.mark.parametrize("spread", [0.001, 1.0])
def test_vector_tasks_stay_bounded_and_meet_every_pair(spark, tmp_path, spread):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal(16) + spread * rng.standard_normal((1200, 16))
    reps = spark.createDataFrame([(1, [float(x) for x in v], i, 1) for i, v in enumerate(vectors)], "_label int, _v array<double>, _rep long, _n long")
    groups = {}
    for r in sj.deal_pairs(reps, 0.14, 1e-9, 8, 50, 200).drop("_raw").collect():
        groups.setdefault(r["_group"], ([], []))[r["_role"]].append(r["_rep"])
    assert max(len(g) for pair in groups.values() for g in pair) <= 100
    near = {(a, b) for ask, see in groups.values() for a in ask for b in see}
    unit = sj.unit(vectors)
    assert {(int(a), int(b)) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.93))} <= near


def test_vectors_of_a_label_travel_once_per_role_and_run(spark):
    vectors = np.random.default_rng(6).standard_normal((3000, 16))
    reps = spark.createDataFrame([(1, [float(x) for x in v], i, 1) for i, v in enumerate(vectors)], "_label int, _v array<float>, _rep long, _n long")
    whole = sj.deal_pairs(reps, 0.14, 1e-9, 8, sj.TASK_VECTORS, sj.CELL_VECTORS)
    assert whole.count() == 2 * 3000
    assert sj.deal_pairs(reps, 0.14, 1e-9, 8, 1000, 2000).count() == 2 * 3 * 3000
    assert "array<float>" in dict(whole.dtypes).values()  # floats are not widened on their way


def test_vectors_empty_table(spark):
    assert sj.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
