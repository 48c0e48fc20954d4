"""Conversation repair by dynamic programming over a grammar.

Each row of a conversation is a symbol: the class of its role and its fault. The cheapest edits that
bring the role initials into ``(s?(ua)+)?`` are a path through a small automaton, so a symbol is a
min-plus transfer matrix between its states; each entry holds a cost and the edits that reach it, as
a rope. Re-Pair replaces frequent neighbouring symbols by rules, over the sequences of all
conversations at once. A rule's matrix is the product of its two parts, computed once, bottom-up;
a conversation multiplies the few matrices its compressed sequence still holds. Long
conversations are cut into chunks, whose matrices are multiplied in order.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from tidemill.llm._shared import materialize

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = ("s", "u", "a", "other")
FAULTS = ("none", "blank", "duplicate", "truncated")
RULES = 512
CHUNK_ROWS = 512
CHUNK_CHARS = 1_000_000
INSERT, REROLE, DELETE, CUT_OFF = 2, 2, 3, 1
#: First code points of plain symbols and of rules.
PLAIN, RULE = 0x21, 0x100
#: Sequences whose edits a Python worker remembers.
REMEMBERED = 50_000

# states: nothing said, after a system row, after a user row, after an assistant row
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
SAID = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDINGS = (NOTHING, ASSISTANT)

#: ``{(from, to): (cost, rank, rope)}``. Ropes are strings or pairs of ropes. Ranks order the strings of one matrix:
#: each holds an edit per row and ends with one, so none is a proper prefix of another, and the order of two products
#: follows from the ranks of their parts.
Matrix = dict[tuple[int, int], tuple[int, int, object]]


def symbol(role: str, fault: str) -> str:
    initial = role[:1]
    return chr(PLAIN + len(FAULTS) * ROLES.index(initial if initial in ROLES else "other") + FAULTS.index(fault))


def next_role(state: int) -> str:
    """The only role but system that may follow."""
    return "a" if state == USER else "u"


def inserts(state: int, most: int = 3) -> Iterator[tuple[int, int]]:
    """``(number, state)``: where up to ``most`` inserted rows lead; more only repeat states at a higher cost."""
    for n in range(most + 1):
        yield n, state
        state = SAID[state, next_role(state)]


def ranked(entries: dict[tuple[int, int], tuple[int, object, object]]) -> Matrix:
    order = {key: i for i, key in enumerate(sorted({key for _, key, _ in entries.values()}))}
    return {at: (cost, order[key], rope) for at, (cost, key, rope) in entries.items()}


def symbol_matrix(plain: str) -> Matrix:
    """Any inserts, then one edit of the row."""
    role, fault = divmod(ord(plain) - PLAIN, len(FAULTS))
    role, fault = ROLES[role], FAULTS[fault]
    best: dict = {}

    def offer(at: tuple[int, int], cost: int, edits: str) -> None:
        if at not in best or (cost, edits) < best[at][:2]:
            best[at] = (cost, edits, edits)

    for start in STATES:
        for n, state in inserts(start):
            offer((start, state), INSERT * n + DELETE, "I" * n + "D")
            if fault in ("blank", "duplicate"):
                continue
            kept = INSERT * n + CUT_OFF * (fault == "truncated")
            if (state, role) in SAID:
                offer((start, SAID[state, role]), kept, "I" * n + "K")
            offer((start, SAID[state, next_role(state)]), kept + REROLE, "I" * n + "R")
    return ranked(best)


def product(left: Matrix, right: Matrix) -> Matrix:
    best: dict = {}
    for (start, mid), (c1, r1, x) in left.items():
        for (mid2, end), (c2, r2, y) in right.items():
            if mid == mid2 and ((start, end) not in best or (c1 + c2, (r1, r2)) < best[start, end][:2]):
                best[start, end] = (c1 + c2, (r1, r2), (x, y))
    return ranked(best)


def flat(rope: object) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += [x[1], x[0]]
    return "".join(out)


def ending(reached: Matrix) -> tuple[int, object, int, str]:
    """``(cost, rope, state, inserted)`` of the best way to end, with the inserts that still follow."""
    best = None
    for (_, state), (cost, rank, rope) in reached.items():
        n, _ = next((n, s) for n, s in inserts(state) if s in ENDINGS)
        if best is None or (cost + INSERT * n, rank, "I" * n) < best[0]:
            best = ((cost + INSERT * n, rank, "I" * n), rope, state)
    return best[0][0], best[1], best[2], best[0][2]


START: Matrix = {(NOTHING, NOTHING): (0, 0, "")}


class Grammar:
    """Rules in the order they were made, and one matrix per symbol, made when first needed from its parts."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices: dict[str, Matrix] = {}
        self.found: dict[str, tuple[int, str]] = {}

    def __reduce__(self):
        return Grammar, (self.rules,)

    def compress(self, sequence: str) -> str:
        for i, pair in enumerate(self.rules):
            sequence = sequence.replace(pair, chr(RULE + i))
        return sequence

    def matrix(self, of: str) -> Matrix:
        if of not in self.matrices:
            if ord(of) < RULE:
                self.matrices[of] = symbol_matrix(of)
            else:
                left, right = self.rules[ord(of) - RULE]
                self.matrices[of] = product(self.matrix(left), self.matrix(right))
        return self.matrices[of]

    def chunk(self, sequence: str) -> Matrix:
        parts = [self.matrix(s) for s in self.compress(sequence)]
        out = parts[0]
        for m in parts[1:]:
            out = product(out, m)
        return out

    def edits(self, sequence: str) -> tuple[int, str]:
        """Cost and audit of a whole conversation."""
        if sequence not in self.found:
            if len(self.found) >= REMEMBERED:
                self.found.clear()
            reached = START
            for s in self.compress(sequence):
                reached = product(reached, self.matrix(s))
            cost, rope, _, more = ending(reached)
            self.found[sequence] = cost, flat(rope) + more
        return self.found[sequence]


def pick(pairs: Iterable[tuple[str, int]], room: int) -> list[str]:
    """Of pairs with counts, most frequent first, those that cannot overlap one picked before."""
    picked: list[str] = []
    begins, ends = set(), set()
    for pair, _ in pairs:
        if len(picked) < room and pair[0] not in ends and pair[1] not in begins and (pair[0] != pair[1] or not picked):
            picked.append(pair)
            begins.add(pair[0])
            ends.add(pair[1])
    return picked


def learn(chunks: DataFrame, rules: int = RULES) -> Grammar:
    """Re-Pair over the sequences of all chunks, many pairs a round. Equal sequences are counted once. Rounds go on until no
    pair occurs twice or there are ``rules`` rules; what is left uncompressed is multiplied symbol by symbol, so
    the bound changes the work, not the result. Only the most frequent pairs of a round reach the driver."""
    sequences = materialize(chunks.where("symbols <> ''").groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "repair-sequences")
    found: list[str] = []
    while len(found) < rules:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for batch in batches:
                for s, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for pair, times in Counter(map("".join, zip(s, s[1:]))).items():
                        counts[pair] += n * times
            yield pa.RecordBatch.from_pydict({"pair": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

        pairs = sequences.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        new = pick([(r["pair"], r["n"]) for r in pairs.orderBy(F.col("n").desc(), "pair").limit(rules).collect()], rules - len(found))
        if not new:
            break
        codes = [(pair, chr(RULE + len(found) + i)) for i, pair in enumerate(new)]
        found += new

        def rewrite(batches: Iterator[pa.RecordBatch], codes=codes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for s in batch.column(0).to_pylist():
                    for pair, code in codes:
                        s = s.replace(pair, code)
                    out.append(s)
                yield pa.RecordBatch.from_pydict({"symbols": pa.array(out, pa.string()), "n": batch.column(1)})

        sequences = materialize(sequences.mapInArrow(rewrite, "symbols string, n long"), "repair-sequences")
    return Grammar(found)


def _read(chunk_rows: int, chunk_chars: int, names: list[str]):
    """Cut sorted rows into chunks and count their faults; a chunk knows whether it is its conversation's last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, done = None, []
        conv, chunk, before_turn, initial = object(), None, None, None

        def opened(conv, at):
            return {"conv": conv, "chunk": at, "last": True, "symbols": [], "roles": [], "texts": [], "lo": None, "hi": None, "turns": 0,
                    "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

        def batch_of(rows):
            columns = {n: [r[n] for r in rows] for n in names}
            columns["symbols"] = ["".join(s) for s in columns["symbols"]]
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

        for batch in batches:
            if schema is None:
                kinds = [batch.schema.field(0).type, pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())] + [pa.int64()] * 7
                schema = pa.schema(list(zip(names, kinds)))
            for c, turn, role, text, again, gone in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if chunk is None or c != conv:
                    if chunk is not None:
                        done.append(chunk)
                    conv, chunk, before_turn, initial, chars = c, opened(c, 0), None, None, 0
                if gone:
                    continue
                if chunk["symbols"] and (len(chunk["symbols"]) >= chunk_rows or chars + len(text) > chunk_chars):
                    chunk["last"] = False
                    done.append(chunk)
                    chunk, chars = opened(c, chunk["chunk"] + 1), 0
                if len(done) >= 64:
                    yield batch_of(done)
                    done = []
                said = text.rstrip(SPACE)
                fault = "blank" if not said else "duplicate" if again else "none" if said[-1] in ENDS else "truncated"
                if fault != "none":
                    chunk[fault] += 1
                if turn is not None:
                    chunk["turns"] += turn != before_turn
                    chunk["lo"], chunk["hi"], before_turn = turn if chunk["lo"] is None else chunk["lo"], turn, turn
                if initial is not None:
                    chunk["illegal"] += initial + role[:1] not in ("su", "ua", "au")
                initial = role[:1]
                chars += len(text)
                chunk["symbols"].append(symbol(role, fault))
                chunk["roles"].append(role)
                chunk["texts"].append(text)
        if chunk is not None:
            done.append(chunk)
        if done:
            yield batch_of(done)
    return run


CHUNK = "chunk long, last boolean, symbols string, roles array<string>, texts array<string>, lo long, hi long, turns long, blank long, duplicate long, truncated long, illegal long"


def _with(conv: StructField, columns: str) -> StructType:
    return StructType([StructField("conv", conv.dataType, True), *StructType.fromDDL(columns)])


def read_chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Chunks of conversations, stored. One shuffle brings a conversation's rows together; they are sorted and read as a
    stream, so a task holds a chunk at a time however long a conversation is."""
    schema = _with(rows.schema["conv"], CHUNK)
    turn = F.col("turn").asc_nulls_first()
    again = F.row_number().over(Window.partitionBy("conv", "role", "text", "gone").orderBy(turn)) > 1
    sorted_ = rows.repartition("conv").withColumn("again", again).sortWithinPartitions("conv", turn, "role", "text", "again")
    return materialize(sorted_.select("conv", "turn", "role", "text", "again", "gone").mapInArrow(_read(chunk_rows, chunk_chars, schema.names), schema), "repair-chunks")


def repaired(state: int, audit: str, roles: list[str], texts: list[str]) -> tuple[list[tuple[str, str, str]], int]:
    """``(edit, role, text)`` of the rows that stay or are new, and the state behind them."""
    out, rows = [], zip(roles, texts)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = {"u": "user", "a": "assistant"}[next_role(state)]
        out.append((edit, role, text))
        state = SAID[state, role[:1]]
    return out, state


COSTS = "chunk long, cost long, state int, audit string"


def plan_edits(chunks: DataFrame, grammar: Grammar) -> DataFrame:
    """``conv, chunk, cost, state, audit`` for the chunks of conversations of several chunks: the chunk's share of the cheapest
    edits, the state before it, and the cost of the whole conversation."""
    conv = chunks.schema["conv"]
    long_ = chunks.where("chunk > 0 OR NOT last").select("conv", "chunk", "last", "symbols")
    entry = "array<struct<start: int, stop: int, cost: long, rank: int, audit: string>>"

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string())]))
        for batch in batches:
            out = [[(a, b, cost, rank, flat(rope)) for (a, b), (cost, rank, rope) in grammar.chunk(s).items()] for s in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, kind)], names=["conv", "chunk", "last", "matrix"])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[tuple[int, Matrix, dict]] = []
        for batch in batches:
            for i, (at, last, entries) in enumerate(zip(*(batch.column(n).to_pylist() for n in (1, 2, 3)))):
                if at == 0:
                    path, reached = [], START
                matrix = {(e["start"], e["stop"]): (e["cost"], e["rank"], (e["start"], e["audit"])) for e in entries}
                step = product(reached, matrix)
                path.append((at, {end: part for (_, end), (_, _, (_, part)) in step.items()}))
                reached = {k: (cost, rank, "") for k, (cost, rank, _) in step.items()}
                if last:
                    cost, _, state, more = ending(reached)
                    rows = []
                    for at, parts in reversed(path):
                        start, audit = parts[state]
                        rows.append((at, cost, start, audit + more))
                        state, more = start, ""
                    conv_of = batch.column(0).take(pa.array([i] * len(rows)))
                    yield pa.RecordBatch.from_arrays([conv_of, *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.string())))],
                                                     names=["conv", "chunk", "cost", "state", "audit"])

    of_chunks = long_.mapInArrow(matrices, _with(conv, f"chunk long, last boolean, matrix {entry}"))
    return of_chunks.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(forward, _with(conv, COSTS))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "position long, edit string, role string, text string"
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _planned(chunks: DataFrame, grammar: Grammar) -> tuple[DataFrame, DataFrame]:
    """Chunks that are a whole conversation, and the others with their edits, in order."""
    edits = plan_edits(chunks, grammar).alias("e")
    c = chunks.where("chunk > 0 OR NOT last").alias("c")
    many = c.join(edits, F.col("c.conv").eqNullSafe(F.col("e.conv")) & (F.col("c.chunk") == F.col("e.chunk"))).select("c.*", "e.cost", "e.state", "e.audit")
    return chunks.where("chunk = 0 AND last"), many.repartition("conv").sortWithinPartitions("conv", "chunk")


def _stream(batches: Iterator[pa.RecordBatch], grammar: Grammar, work) -> Iterator[pa.RecordBatch]:
    """Call ``work(chunk, cost, state, audit)`` for each chunk; a whole conversation's edits are found here."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names) if j}
            if "audit" in row:
                found = row["cost"], row["state"], row["audit"]
            else:
                cost, audit = grammar.edits(row["symbols"])
                found = cost, NOTHING, audit
            out = work(row, *found)
            if out is not None:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(out[0]))), *out[1]], names=["conv", *out[2]])


def prepare(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """``conv, turn, role, text, gone`` with null roles and texts as one space."""
    left_out = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    filled = lambda c: F.when(left_out, F.lit("")).otherwise(F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"), left_out.alias("gone"))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None,
           rules: int = RULES, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn (nulls first; ties by role, then text). A row's first fault counts: blank (nothing but ASCII
    white space), duplicate (same role and text earlier in the conversation), truncated (its last other character is not
    one of ``.!?``). ``gaps``: turns missing between the least and the largest (null turns left out). ``illegal``: neighbours
    whose role initials are not su, ua or au. The edits bring the initials into ``(s?(ua)+)?`` at least cost: keep 0, rerole
    to user or assistant 2, delete 3 (the only edit of blank and duplicate rows), insert an empty user or assistant row 2,
    and 1 for a truncated row that is not deleted. ``audit``: their initials in order, of equally cheap ones the least in
    ASCII order. ``repaired_sha256``: of ``role:text`` of the repaired rows, joined by newlines.

    Null roles and texts count as one space; null conversations are one conversation; a conversation with no rows but
    ``gone`` ones (a boolean column) has zeros, an empty audit and the digest of nothing. An empty table gives an empty
    result; other columns are ignored. A conversation's rows pass through one task in order, since its digest is
    sequential, but only a chunk of it is held at a time."""
    chunks = read_chunks(prepare(rows, conv, turn, role, text, gone), chunk_rows, chunk_chars)
    return summarise(chunks, learn(chunks, rules)).withColumnRenamed("conv", conv)


def summarise(chunks: DataFrame, grammar: Grammar) -> DataFrame:
    schema = _with(chunks.schema["conv"], RESULT)
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict = {}

        def work(row, cost, state, audit):
            if row["chunk"] == 0:
                now.update(digest=hashlib.sha256(), any=False, audit=[], lo=None, hi=None, turns=0, **dict.fromkeys(COUNTS, 0))
            for edit, role, text in repaired(state, audit, row["roles"], row["texts"])[0]:
                now["digest"].update(f"{chr(10) if now['any'] else ''}{role}:{text}".encode())
                now["any"] = True
            now["audit"].append(audit)
            now["lo"], now["hi"] = row["lo"] if now["lo"] is None else now["lo"], now["hi"] if row["hi"] is None else row["hi"]
            for n in ("turns", *COUNTS):
                now[n] += row[n]
            if row["last"]:
                gaps = 0 if now["lo"] is None else now["hi"] - now["lo"] + 1 - now["turns"]
                values = [gaps, *(now[n] for n in COUNTS), cost, "".join(now["audit"]), now["digest"].hexdigest()]
                return [0], [pa.array([v], k) for v, k in zip(values, kinds)], schema.names[1:]

        yield from _stream(batches, grammar, work)

    whole, many = _planned(chunks, grammar)
    return whole.mapInArrow(run, schema).unionAll(many.mapInArrow(run, schema))


def repaired_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None,
                   rules: int = RULES, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``conv, position, edit, role, text``: the rows of the repaired conversations, numbered from 0, with the edit (K, R or I)
    that each comes from. Everything else as in ``repair``."""
    chunks = read_chunks(prepare(rows, conv, turn, role, text, gone), chunk_rows, chunk_chars)
    grammar = learn(chunks, rules)
    schema = _with(chunks.schema["conv"], TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [0]

        def work(row, cost, state, audit):
            if row["chunk"] == 0:
                at[0] = 0
            out = repaired(state, audit, row["roles"], row["texts"])[0]
            first, at[0] = at[0], at[0] + len(out)
            if out:
                edits, roles, texts = zip(*out)
                return out, [pa.array(range(first, at[0]), pa.int64()), *(pa.array(c, pa.string()) for c in (edits, roles, texts))], schema.names[1:]

        yield from _stream(batches, grammar, work)

    whole, many = _planned(chunks, grammar)
    return whole.mapInArrow(run, schema).unionAll(many.mapInArrow(run, schema)).withColumnRenamed("conv", conv)
