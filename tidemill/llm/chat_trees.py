r"""Chat formatting from reply trees.

Root-to-leaf paths are enumerated by iterative self-joins (each join doubles the reach, so a chain
of ``n`` turns takes ``log2 n`` joins), branches are ranked by score, and each chosen path becomes
one formatted conversation with its loss mask. DataFrame operations only.

Template, per turn: ``### ROLE: TEXT </turn>\n``. Escapes inside texts and roles: ``\`` is written
``\b``, ``#`` is ``\h``, ``<`` is ``\l`` and, in roles, ``:`` is ``\c``. No text can then hold a
control string, and every backslash starts an escape, so the text reads back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm._shared import materialize

TURN_END = " </turn>\n"
LOSS_ROLE = "assistant"


def _replace(c: Column, a: str, b: str) -> Column:
    return F.replace(c, F.lit(a), F.lit(b))


def escape(text: Column, role: bool = False) -> Column:
    out = _replace(_replace(_replace(text, "\\", "\\b"), "#", "\\h"), "<", "\\l")
    return _replace(out, ":", "\\c") if role else out


def unescape(text: Column) -> Column:
    return _replace(_replace(_replace(_replace(text, "\\c", ":"), "\\l", "<"), "\\h", "#"), "\\b", "\\")


def chain_nodes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Reply tree of plain conversations: each turn answers the one before it. Turns with equal numbers
    follow each other by role and text; a null turn number comes first. Columns: ``tree, node,
    parent, role, text, score``; a null conversation id is one tree."""
    order = Window.partitionBy("tree").orderBy(F.col(turn_col).asc_nulls_first(), "role", "text")
    named = turns.select(F.struct(F.col(conv_col).alias("id")).alias("tree"), F.col(turn_col),
                         F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    node = F.row_number().over(order).cast("long")
    return named.select("tree", node.alias("node"), "role", "text").select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branch_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """``tree, leaf, node, back, branch``: the nodes of the chosen root-to-leaf paths, ``back`` steps
    before the leaf. Branches of a tree are ranked by the mean score of their nodes, then length,
    then leaf; ``branches=None`` takes all.

    ``nodes``: ``tree, node, parent, score``; null scores count as 0; repeated rows of a node count
    once; a parent that is missing makes its child a root; nodes on a cycle have no leaf
    below them and give no path, and a leaf that hangs on a cycle is not possible in a tree (raises).
    """
    ids = materialize(nodes.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.max(F.coalesce("score", F.lit(0.0))).alias("score")), "tree-nodes")
    real = ids.select("tree", F.col("node").alias("parent"))
    jump = ids.where("parent IS NOT NULL").join(real, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up"))
    leaves = ids.join(ids.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct(), ["tree", "node"], "left_anti")
    paths = materialize(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")), "tree-paths")
    jump = materialize(jump, "tree-jumps")
    reach, limit = 1, ids.count()
    while not jump.isEmpty():
        if reach > limit:
            raise ValueError("the replies of a tree form a cycle")
        longer = paths.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("back") + reach).alias("back"))
        paths = materialize(paths.unionAll(longer), "tree-paths")
        far = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("_far"))
        jump = materialize(jump.join(far, ["tree", "up"]).select("tree", "node", F.col("_far").alias("up")), "tree-jumps")
        reach *= 2
    scored = paths.join(ids.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(
        F.avg("score").alias("_mean"), F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("_mean"), F.desc("_n"), "leaf"))
    chosen = scored.withColumn("branch", rank)
    if branches is not None:
        chosen = chosen.where(F.col("branch") <= branches)
    return paths.join(chosen.select("tree", "leaf", "branch"), ["tree", "leaf"])


def format_trees(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """One row per chosen path: ``tree, branch, formatted, loss_mask``.

    ``loss_mask`` cuts ``formatted`` into a run per turn, ``(skip, loss, rest)`` code points: only
    the text of an assistant turn bears loss. Empty and null texts make empty turns; an empty table
    gives no rows. A conversation is one output row, so its texts meet in one task; nothing else
    is gathered."""
    one = nodes.groupBy("tree", "node").agg(F.min(F.struct("role", "text")).alias("_t")).select("tree", "node", "_t.role", "_t.text")
    role, text = escape(F.col("role"), True), escape(F.col("text"))
    head = F.concat(F.lit("### "), role, F.lit(": "))
    loss = F.when(F.col("role") == LOSS_ROLE, F.length(text)).otherwise(F.lit(0))
    turn = F.concat(head, text, F.lit(TURN_END))
    run = F.struct(F.length(head).alias("skip"), loss.alias("loss"), (F.length(turn) - F.length(head) - loss).alias("rest"))
    rows = branch_paths(nodes, branches).join(one, ["tree", "node"])
    parts = F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("k"), turn.alias("turn"), run.alias("run"))))
    return rows.groupBy("tree", "branch").agg(parts.alias("_p")).select(
        "tree", "branch", F.array_join("_p.turn", "").alias("formatted"), F.col("_p.run").alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text, unescaped) and ``loss_texts`` (what the mask selects, unescaped)."""
    pieces = F.split("formatted", TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    body = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, 5, 2147483647), ": ", 1)).alias("role"),
        unescape(p.substr(F.locate(": ", p) + 2, F.length(p))).alias("text")))
    masked = F.transform(F.arrays_zip(pieces.alias("p"), F.col("loss_mask").alias("m")),
                         lambda x: F.struct((x["m"]["loss"] > 0).alias("on"), unescape(x["p"].substr(x["m"]["skip"] + 1, x["m"]["loss"])).alias("text")))
    kept = F.transform(F.filter(masked, lambda x: x["on"]), lambda x: x["text"])
    return formatted.withColumn("turns", body).withColumn("loss_texts", kept)
