"""Queries of the training-data operators, one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    chat_trees, conversation_repair, crf_langid, exact_dedup, fuzzy_lines, html_main, mixing, packing, secret_scan, spelling, subspace_join, vantage_trees,
    weighted_minhash,
)
from tidemill.llm._shared import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""


#: A conversation whose texts look like the template itself.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(F.lit(TRICKY_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY_TEXT).alias("text"))
    out = chat_trees.read_back(chat_trees.format_trees(chat_trees.chain_nodes(turns.unionByName(tricky))))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return out.select(F.col("tree.id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP2_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
    SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) AS n_text,
           length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', '')) AS n_role
    FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + n_role + 2 + n_text + 9) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), max_bits=None, short_lines=True)
    return out.select("doc_id", "lines_total", "lines_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), words=secret_scan.vocabulary_words(tokenizer_path()))
    written = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(spans, s -> s.kind <> 'guess')"
    count = "cast(size(filter(spans, s -> s.kind = '{}')) as long) n_{}"
    return found.selectExpr("doc_id", *(count.format(k, k) for k in secret_scan.KINDS),
                            f"sha2({written.format(base)}, 256) base_sha256", f"{written.format('spans')} spans")


def op5_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op6_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.near_classes(table(spark, sf_dir, "documents")).drop("_rid")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_pages(table(spark, sf_dir, "pages"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, takes = mixing.mix(table(spark, sf_dir, "documents"))
    taken = takes.groupBy("_rid").agg(F.sum("words").alias("taken"))
    return (rows.join(taken, "_rid", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return crf_langid.identify(docs).select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_vectors(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), link AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.e, y.e) >= 0.93
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM v
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT r.vec_id, (SELECT count(*) FROM link WHERE a = r.vec_id) AS n_links, r.component_id, r.vec_id = r.component_id AS kept
FROM root r
"""


#: Each document misspells one of so many words.
DAMAGE_EVERY = 199


def op11_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), damage_every=DAMAGE_EVERY)
    return spelling.variants(words)


OP11_SQL = r"""
WITH RECURSIVE run AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')) AS r FROM documents) GROUP BY ALL
), summed AS (
    SELECT run, c, list_reduce(list_transform(flatten(list_transform(range(1, len(h) // 2 + 1),
               lambda i: [CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), lambda x: x),
               lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, (s & 1) * 3988292384) END, CAST(4294967295 AS BIGINT)) AS s
    FROM (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM run)
), told AS (
    SELECT run, c, xor(s, 4294967295) AS h FROM summed
), words AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
        SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM told)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), cut AS (
    SELECT word, n, substr(word, 1, CAST(i AS BIGINT)) AS a, substr(word, CAST(i AS BIGINT) + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pair AS (
    SELECT x.word, y.word AS other, y.n AS m FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON y.word = x.a || x.b
    UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON y.word = x.a || x.b
), best AS (
    SELECT word, count(*) AS n_near, max(m) AS m FROM pair GROUP BY word
), judged AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 5 * w.n THEN b.m END AS form_n,
           CASE WHEN b.m >= 5 * w.n THEN (SELECT min(other) FROM pair p WHERE p.word = w.word AND p.m = b.m) END AS form
    FROM words w LEFT JOIN best b USING (word)
), chain AS (
    SELECT word, word AS at FROM words
    UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NOT NULL
), last AS (
    SELECT c.word, c.at AS root FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN last USING (word)
"""


#: Factor 1: no neighbour is missed.
PRUNING_FACTOR = 1.0
NEIGHBOURS = 5


def op12_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_trees.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, NEIGHBOURS, PRUNING_FACTOR)


OP12_SQL = """
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), near AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM near
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
"""


def damaged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``conversations`` with a fault each by a checksum of conversation and turn; dropped rows are marked."""
    rows = table(spark, sf_dir, "conversations")
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(told("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"),
                       F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(damaged_conversations(spark, sf_dir), gone="gone")


OP13_SQL = r"""
WITH RECURSIVE hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations
), marked AS (
    SELECT *, xor(list_reduce(flatten(list_transform(range(1, len(h) // 2 + 1),
               lambda i: [CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
               lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, (s & 1) * 3988292384) END, CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS k FROM hashed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM marked WHERE k <> 0)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), judged AS (
    SELECT conv_id, turn, i, role, text, role[1] AS c, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS b,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault FROM placed
), go(st, c, st2) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), ins(st, n, mid, lines) AS (
    VALUES ('', 0, '', CAST([] AS VARCHAR[])), ('s', 0, 's', []), ('u', 0, 'u', []), ('a', 0, 'a', []), ('', 1, 'u', ['user:']), ('s', 1, 'u', ['user:']),
           ('u', 1, 'a', ['assistant:']), ('a', 1, 'u', ['user:']), ('', 2, 'a', ['user:', 'assistant:']), ('s', 2, 'a', ['user:', 'assistant:'])
), edit AS (
    SELECT st, n, lines, 'D' AS e, '' AS c, mid AS st2, 2 * n + 3 AS cost FROM ins
    UNION ALL SELECT i.st, n, lines, 'K', g.c, g.st2, 2 * n FROM ins i JOIN go g ON g.st = i.mid
    UNION ALL SELECT i.st, n, lines, 'R', g.c, g.st2, 2 * n + 2 FROM ins i JOIN go g ON g.st = i.mid WHERE g.c <> 's'
), path AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM judged
    UNION ALL
    SELECT * FROM (
        SELECT p.conv_id, j.i, o.st2 AS st, p.cost + o.cost + CAST(o.e <> 'D' AND j.fault = 'truncated' AS INTEGER) AS cost,
               p.audit || repeat('I', o.n) || o.e AS audit,
               p.lines || o.lines || CASE o.e WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [j.role || ':' || j.text]
                                     ELSE [CASE o.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || j.text] END AS lines
        FROM path p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.i = p.i + 1
        JOIN edit o ON o.st = p.st AND (o.e = 'D' OR j.fault IN ('none', 'truncated') AND (o.e = 'R' OR o.c = j.c)))
    QUALIFY row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) = 1
), total AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE i > 1 AND b || c NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), repaired AS (
    SELECT t.*, p.cost + 2 * e.n AS cost, p.audit || repeat('I', e.n) AS audit, array_to_string(p.lines || e.lines, chr(10)) AS text
    FROM total t JOIN path p ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.i = t.n JOIN ins e ON e.st = p.st AND e.mid IN ('', 'a')
    QUALIFY row_number() OVER (PARTITION BY t.conv_id ORDER BY p.cost + 2 * e.n, p.audit || repeat('I', e.n)) = 1
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_secret_scan": op4_secret_scan,
    "op5_pack_documents": op5_pack_documents,
    "op6_weighted_minhash": op6_weighted_minhash,
    "op7_main_text": op7_main_text,
    "op8_mix_sources": op8_mix_sources,
    "op9_language_id": op9_language_id,
    "op10_near_vectors": op10_near_vectors,
    "op11_spelling_forms": op11_spelling_forms,
    "op12_vantage_neighbours": op12_vantage_neighbours,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op2_chat_format": OP2_SQL, "op10_near_vectors": OP10_SQL, "op11_spelling_forms": OP11_SQL, "op12_vantage_neighbours": OP12_SQL,
                       "op13_conversation_repair": OP13_SQL}
