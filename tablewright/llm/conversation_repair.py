"""Conversation structure repair by Four-Russians block tables.

A conversation must read `(s?(ua)+)?` in the first letters of its roles: nothing, or one system turn at most and then turns of user and assistant by
turns. Rows that are blank or repeat an earlier role and text must go. The cheapest edits are wanted: Keep (0), Rerole to user or assistant (1), Delete
(2), Insert an empty user or assistant turn (5); a kept or reroled row whose text ends without `.`, `!` or `?` costs 5 more. Of equal costs the
edits whose first letters sort first in ASCII win.

What counts of a row is one of nine symbols: its role (system, user, assistant, other) with or without a full end, or "must go". What is left to pay
from a row on is a vector over the four states of the pattern. Less its least entry, only a few dozen such vectors exist, as inserts tie the states
together. So a block of BLOCK symbols maps each vector to a vector and an amount, and all 9 ** BLOCK blocks are worked out beforehand. A conversation is
paid from its end to its start, one lookup for each block; then it is walked from its start, and each block is opened from its end again, so
that every step can take the first letter that stays on a cheapest way. Inserts come before the row they stand at; the state after an edit follows
from its letter, so the walk never forks.

On Spark: rows are reduced to facts (turn, digest of role and text, symbol), equal rows of one turn to one fact with a count, before anything is dealt out.
What came earlier is the smallest turn of a digest, joined with hot digests apart. Facts are dealt by ranges of (conversation, turn, digest), so a
conversation of any size lies on as many tasks as it fills, and each Arrow batch gives a chunk of one byte a row. Only these bytes meet in one row per
conversation, which is as long as its `audit` anyway. Texts meet their edits in sorted order, streamed, never held; a digest over a
whole conversation has to be worked out in one stream.

Defined results. Null roles and texts are one space; a null conv_id is a conversation of its own. Null turns come first. Rows of one turn are ordered by
the digest of role and text, so repeated rows stand side by side. A conversation without rows (`copies` 0) has zeros and an empty audit. Turns may
leave gaps, repeat and be negative. Roles are told by their first letter, in lower case; an empty role is none of the three. Empty tables give
empty results. Very long texts pass as they are; other columns of the caller are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import join_hot, kept_by_worker, map_batches, table, written

BLOCK = 4
SYMBOLS, MUST_GO = 9, 8
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant. What is put in next, and where keeping a role leads.
NEXT = (2, 2, 3, 2)
KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
ENDS = (0, 3)
ROLES = {2: "user", 3: "assistant"}
SPACES = " \t\n\x0b\x0c\r"


def with_inserts(left: list[float]) -> tuple[float, ...]:
    for _ in range(3):
        left = [min(v, INSERT + left[NEXT[q]]) for q, v in enumerate(left)]
    return tuple(left)


def before(symbol: int, left: tuple[float, ...]) -> tuple[float, ...]:
    """What is left to pay before a row, by what is left after it."""
    out = []
    for q in range(4):
        ways = [DELETE + left[q]]
        if symbol != MUST_GO:
            more = UNFINISHED * (symbol % 2)
            ways.append(REROLE + more + left[NEXT[q]])
            if q in KEEP[symbol // 2]:
                ways.append(more + left[KEEP[symbol // 2][q]])
        out.append(min(ways))
    return with_inserts(out)


def vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, next, paid): the vectors less their least entry that occur, and for [symbol, vector] the vector before that symbol and the amount taken off."""
    last = with_inserts([0 if q in ENDS else float("inf") for q in range(4)])
    found, queue, steps = {last: 0}, [last], {}
    while queue:
        at = queue.pop()
        for symbol in range(SYMBOLS):
            full = before(symbol, at)
            low = min(full)
            new = tuple(v - low for v in full)
            if new not in found:
                found[new] = len(found)
                queue.append(new)
            steps[symbol, found[at]] = (found[new], low)
    pairs = np.array([[steps[s, v] for v in range(len(found))] for s in range(SYMBOLS)], np.int64)
    return np.array(list(found), np.int64), pairs[:, :, 0], pairs[:, :, 1]


class Tables:
    """The vectors, the tables of all blocks, and the blocks that were opened, REMEMBERED of them at most. Each worker makes its own once."""

    REMEMBERED = 100_000

    def __init__(self) -> None:
        self.vector, self.one, self.paid = vectors()
        # For [block, vector]; blocks number their symbols with the first one highest.
        self.to, self.cost = self.one, self.paid
        for _ in range(BLOCK - 1):  # one more symbol in front
            self.to, self.cost = self.one[:, self.to].reshape(-1, self.to.shape[1]), (self.cost[None] + self.paid[:, self.to]).reshape(-1, self.to.shape[1])
        self.edits: dict[tuple[bytes, int, int], tuple[str, int]] = {}

    def opened(self, symbols: bytes, after: int, state: int) -> tuple[str, int]:
        """The edits of some symbols, entered in a state, with the vector after them; and the state then."""
        key = (symbols, after, state)
        if key not in self.edits:
            if len(self.edits) >= self.REMEMBERED:
                self.edits.clear()
            self.edits[key] = walked(symbols, after, state, self.vector, self.one, self.paid)
        return self.edits[key]


def walked(symbols: bytes, after: int, state: int, vector: np.ndarray, one: np.ndarray, paid: np.ndarray) -> tuple[str, int]:
    held = [after]
    for s in reversed(symbols):
        held.append(int(one[s, held[-1]]))
    edits = []
    for s, a, b in zip(symbols, held[-2::-1], held[:0:-1], strict=True):
        left, whole = vector[a], vector[b] + paid[s, a]  # after and before this row
        more = UNFINISHED * (s % 2)
        while DELETE + left[state] != whole[state] and INSERT + whole[NEXT[state]] == whole[state]:
            edits.append("I")
            state = NEXT[state]
        if DELETE + left[state] == whole[state]:
            edits.append("D")
        elif state in KEEP[s // 2] and more + left[KEEP[s // 2][state]] == whole[state]:
            edits.append("K")
            state = KEEP[s // 2][state]
        else:
            edits.append("R")
            state = NEXT[state]
    return "".join(edits), state


def audit_of(symbols: bytes) -> tuple[int, str]:
    """Cost and edits of a conversation."""
    t = kept_by_worker(("conversation repair",), Tables)
    vector, paid, to, cost, opened = t.vector, t.paid, t.to, t.cost, t.opened
    n = len(symbols) // BLOCK
    tail = symbols[n * BLOCK :]
    numbers = np.frombuffer(symbols[: n * BLOCK], np.uint8).reshape(n, BLOCK) @ (SYMBOLS ** np.arange(BLOCK)[::-1])
    v, total = 0, 0
    for s in reversed(tail):
        total += int(paid[s, v])
        v = int(t.one[s, v])
    after = np.zeros(n, np.int16)  # the vector behind each block
    for k in range(n - 1, -1, -1):
        after[k] = v
        total += int(cost[numbers[k], v])
        v = int(to[numbers[k], v])
    total += int(vector[v][0])
    parts, state = [], 0
    for k in range(n):
        edits, state = opened(symbols[k * BLOCK : (k + 1) * BLOCK], int(after[k]), state)
        parts.append(edits)
    edits, state = opened(tail, 0, state)
    parts.append(edits)
    while state not in ENDS:
        parts.append("I")
        state = NEXT[state]
    return total, "".join(parts)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows as a bad export leaves them, by crc32(`conv_id:turn`) % 20; `copies` is 0 for a row that is dropped."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")), F.lit(20))
    text = F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(h == 4, F.lit("user")).otherwise(one("role")).alias("role"), text.alias("text"), F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"))


def digest() -> Column:
    """16 bytes that stand for role and text."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))


def keyed(rows: DataFrame) -> DataFrame:
    """conv (the id as text, one space for null), known and turn (nulls first), role, text, copies, digest."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select(one("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), one("role").alias("role"), one("text").alias("text"), copies.cast("long").alias("copies"))
    return rows.withColumns({"known": F.col("turn").isNotNull(), "digest": F.when(F.col("copies") > 0, digest())})


def symbol_facts(rows: DataFrame) -> DataFrame:
    """conv, known, turn, digest, n, kind, blank, open, again: one row for the equal rows of a turn; `again` if an earlier turn has the digest."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    kind = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(F.startswith("role", F.lit("a")), 2).otherwise(3)
    marked = rows.select("conv", "known", "turn", "digest", "copies", kind.alias("kind"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"))
    facts = marked.groupBy("conv", "known", "turn", "digest").agg(F.sum("copies").alias("n"), F.max("kind").alias("kind"), F.max("blank").alias("blank"), F.max("open").alias("open"))
    facts = written(facts, "repair-facts")
    order = F.struct("known", "turn")
    several = facts.where("digest IS NOT NULL").groupBy("conv", "digest").agg(F.count("*").alias("rows"), F.min(order).alias("first")).where("rows > 1")
    placed = join_hot(facts, written(several, "repair-repeats"), ["conv", "digest"], "rows")
    return placed.select("conv", "known", "turn", "digest", "n", "kind", "blank", "open", F.coalesce(F.col("first") < order, F.lit(False)).alias("again"))


CHUNK = "conv string, part int, k int, symbols binary, blank long, duplicate long, truncated long, illegal long, first_kind int, last_kind int, low long, high long, turns long, first_turn long, last_turn long"


def chunks(facts: DataFrame) -> DataFrame:
    """The symbols of the ordered rows, a chunk for each Arrow batch and conversation in it, with what is counted in it. (part, k) orders chunks."""
    order = ["conv", "known", "turn", "digest"]
    ordered = facts.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), itertools.count()
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_pylist()
            n, kind = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("n", "kind"))
            blank, unfinished, again = (np.array(batch.column(c).to_pylist(), bool) for c in ("blank", "open", "again"))
            turn = batch.column("turn").to_pylist()
            edges = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
            out: list[list] = [[] for _ in range(15)]
            for a, b in itertools.pairwise(edges):
                live = np.flatnonzero(n[a:b] > 0) + a
                copies = n[live]
                goes = blank[live] | again[live]
                symbols = np.full(int(copies.sum()), MUST_GO, np.uint8)
                at = np.cumsum(copies) - copies
                symbols[at] = np.where(goes, MUST_GO, kind[live] * 2 + unfinished[live])
                kinds = np.repeat(kind[live], copies)
                # Roles follow one another rightly as system-user, user-assistant and assistant-user.
                wrong = ~np.isin(kinds[:-1] * 4 + kinds[1:], (1, 6, 9))
                own = [turn[i] for i in live if turn[i] is not None]
                row = (
                    conv[a], part, next(k), symbols.tobytes(), int(copies[blank[live]].sum()), int(np.where(blank[live], 0, np.where(again[live], copies, copies - 1)).sum()),
                    int((~goes & unfinished[live]).sum()), int(wrong.sum()), *((int(kinds[0]), int(kinds[-1])) if len(kinds) else (None, None)),
                    *((own[0], own[-1]) if own else (None, None)), len(set(own)), *((own[0], own[-1]) if own else (None, None)),
                )
                for column, v in zip(out, row, strict=True):
                    column.append(v)
            types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.int32(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], [c.split()[0] for c in CHUNK.split(", ")])

    return map_batches(ordered, cut, CHUNK)


REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def report(rows: DataFrame) -> DataFrame:
    """conv, the counts of faults, cost and audit of every conversation."""
    fields = [c.split()[0] for c in CHUNK.split(", ")][1:]
    whole = chunks(symbol_facts(keyed(rows))).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("chunks"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, own in zip(batch.column("conv").to_pylist(), batch.column("chunks").to_pylist(), strict=True):
                cost, audit = audit_of(b"".join(c["symbols"] for c in own))
                live = [c for c in own if c["first_kind"] is not None]
                illegal = sum(c["illegal"] for c in own) + sum(a["last_kind"] * 4 + b["first_kind"] not in (1, 6, 9) for a, b in itertools.pairwise(live))
                dated = [c for c in own if c["low"] is not None]
                turns = sum(c["turns"] for c in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in itertools.pairwise(dated))
                gaps = dated[-1]["high"] - dated[0]["low"] + 1 - turns if dated else 0
                out.append((conv, gaps, *(sum(c[f] for c in own) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string() if i in (0, 7) else pa.int64()) for i in range(8)], [c.split()[0] for c in REPORT.split(", ")])

    return map_batches(whole, solve, REPORT)


EDITED = "conv string, place long, edit string, turn long, role string, text string"


def edited(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """conv, place, edit, turn, role, text: every row with its edit and the inserted ones, in order. Deleted rows are listed as they were.

    The rows of a conversation stand in one partition in the order of `place`, behind the audit, which is read as they pass."""
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("digest", "binary"), ("role", "string"), ("text", "string"), ("copies", "long"))]
    notes = reports.select("conv", F.lit(0).alias("kind"), F.lit(False).alias("known"), "audit", *empty)
    lines = keyed(rows).where("copies > 0").select("conv", F.lit(1).alias("kind"), "known", F.lit(None).cast("string").alias("audit"), "turn", "digest", "role", "text", "copies")
    ordered = notes.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "kind", "known", "turn", "digest")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, tail, state = None, "", 0, 0, 0
        out: list[tuple] = []

        def inserted() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = NEXT[state]
                out.append((conv, at, "I", None, ROLES[state], ""))
                at += 1

        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    conv, audit, at, state = r["conv"], r["audit"], 0, 0
                    tail = len(audit.rstrip("I"))  # inserts from here on stand behind the last row
                    continue
                kind = "sua".find(r["role"][:1] or "-")
                for _ in range(r["copies"]):
                    inserted()
                    edit, role = audit[at], r["role"]
                    if edit == "K":
                        state = KEEP[kind][state]
                    elif edit == "R":
                        state = NEXT[state]
                        role = ROLES[state]
                    out.append((conv, at, edit, r["turn"], role, r["text"]))
                    at += 1
                if at == tail:
                    inserted()
            names, types = zip(*(c.split() for c in EDITED.split(", ")), strict=True)
            kinds = {"string": pa.string(), "long": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[t]) for i, t in enumerate(types)], list(names))
            out = []

    return map_batches(ordered, apply, EDITED)


def digests(rows: DataFrame) -> DataFrame:
    """conv, repaired_sha256 of rows as `edited` gives them: what is left as `role:text`, joined by line feeds."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, started = None, hashlib.sha256(), False
        for batch in batches:
            done = []
            for c, edit, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "edit", "role", "text")), strict=True):
                if c != conv:
                    if conv is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state, started = c, hashlib.sha256(), False
                if edit != "D":
                    state.update((("\n" if started else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                    started = True
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["conv", "repaired_sha256"])
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], ["conv", "repaired_sha256"])

    return map_batches(rows.select("conv", "edit", "role", "text"), stream, "conv string, repaired_sha256 string")


def conversation_id() -> Column:
    return F.when(F.col("conv") != " ", F.col("conv").cast("long")).alias("conv_id")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, edits) of conversations (conv_id, turn, role, text and, if rows stand for several, copies)."""
    reports = written(report(rows), "repair-reports")
    return reports, edited(rows, reports)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports, edits = repair(damage(table(spark, sf_dir, "conversations")))
    out = reports.join(digests(edits), "conv", "left")
    return out.select(conversation_id(), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def oracle_sql() -> str:
    """What `query` gives, as DuckDB states it: costs, edits and lines of the four states carried forward row by row, the least (cost, edits) kept. Without ties of turns."""
    crc = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)), lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    move = lambda state, cost, letter, line=None: f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {f'list_append({state}.t, {line})' if line else f'{state}.t'}}} END"
    only = lambda cond, value: f"CASE WHEN {cond} THEN {value} END"
    best = lambda *ways: f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"
    more, own = f"{UNFINISHED} * cut", "role || ':' || text"
    keep = lambda q, letter: only(f"NOT gone AND left(role, 1) = '{letter}'", move(q, more, "K", own))
    rerole = lambda q, to: only("NOT gone", move(q, f"({REROLE} + {more})", "R", f"'{ROLES[to]}:' || text"))
    delete = lambda q: move(q, DELETE, "D")
    steps = [best(delete("s0")), best(delete("s1"), keep("s0", "s")), best(delete("s2"), *[keep(q, "u") for q in ("s0", "s1", "s3")], *[rerole(q, 2) for q in ("s0", "s1", "s3")]), best(delete("s3"), keep("s2", "a"), rerole("s2", 3))]
    user = best("n2", *[move(q, INSERT, "I", "'user:'") for q in ("n0", "n1", "n3")])
    answer = best("n3", move("m2", INSERT, "I", "'assistant:'"))
    kind = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"
    return f"""WITH RECURSIVE b AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, {crc} % 20 AS h FROM b), d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM h, range(CASE WHEN h = 0 THEN 0 WHEN h = 3 THEN 2 ELSE 1 END) WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, {spaces}) AS bare FROM d),
r AS (SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, right(bare, 1) NOT IN ('.', '!', '?') AS open_, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
f AS (SELECT *, blank OR again AS gone, CASE WHEN open_ THEN 1 ELSE 0 END AS cut FROM r),
g AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open_ AND NOT gone) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
c0 AS (SELECT {{'c': 0, 'a': '', 't': []::VARCHAR[]}}::{kind} AS n0, NULL::{kind} AS n1, NULL::{kind} AS n2, NULL::{kind} AS n3),
c1 AS (SELECT *, {user} AS m2 FROM c0), start AS (SELECT n0 AS s0, n1 AS s1, m2 AS s2, {answer} AS s3 FROM c1),
w AS (SELECT conv_id, 0::BIGINT AS i, start.* FROM g, start UNION ALL
SELECT conv_id, i, n0, n1, m2, {answer} FROM (SELECT *, {user} AS m2 FROM (SELECT w.conv_id, f.i, {', '.join(f'{x} AS n{q}' for q, x in enumerate(steps))} FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1))),
z AS (SELECT w.conv_id, {best('s0', 's3')} AS e, gaps, blank, duplicate, truncated, illegal FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = g.n)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(array_to_string(e.t, chr(10)), '')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN z ON a.conv_id IS NOT DISTINCT FROM z.conv_id"""
