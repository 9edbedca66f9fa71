"""Conversation repair against a shortest path over whole edit strings."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("tablewright.llm")

from tablewright.llm import conversation_repair as R  # noqa: E402

SPACE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """rows: (initial, truncated, must go). The least (cost, edits) and the repaired roles, by a search over (row, roles so far in short)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, edits, i, state, done = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, edits, done
        for letter, to in {0: "s1u2", 1: "u2", 2: "a3", 3: "u2"}[state] and [(x, int(y)) for x, y in zip(*[iter({0: "s1u2", 1: "u2", 2: "a3", 3: "u2"}[state])] * 2)]:
            role = {"u": "user", "a": "assistant"}.get(letter)
            if role:
                heapq.heappush(heap, (cost + 5, edits + "I", i, to, (*done, (None, role))))
            if i < len(rows) and not rows[i][2]:
                more = 5 * rows[i][1]
                if rows[i][0] == letter:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, to, (*done, (i, None))))
                if role:
                    heapq.heappush(heap, (cost + more + 1, edits + "R", i + 1, to, (*done, (i, role))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, state, done))
    raise AssertionError


def test_audit_is_the_cheapest_and_least():
    draw = random.Random(5)
    for _ in range(3000):
        n = draw.randrange(0, 14)
        rows = [(draw.choice("suuaaax"), draw.random() < 0.25, draw.random() < 0.2) for _ in range(n)]
        symbols = bytes(R.MUST_GO if gone else "suax".index(c) * 2 + cut for c, cut, gone in rows)
        cost, edits, _ = cheapest(rows)
        assert R.audit_of(symbols) == (cost, edits)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def expected(rows):
    want, left = {}, damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, digest(r[2], r[3])))
        seen, marks, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            full = SPACE.findall(text)
            fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marks.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault == "truncated", fault in ("blank", "duplicate")))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:], strict=False))
        cost, edits, done = cheapest(marks)
        lines = [f"{role or own[i][2]}:{'' if i is None else own[i][3]}" for i, role in done]
        want[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return want


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(spark, rows, tmp_path):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in R.query(spark, str(tmp_path)).collect()}
    assert got == expected(rows)


def test_query_on_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in R.query(spark, sf_dir).collect()}
    assert got == expected(rows)


def test_query_on_odd_rows(spark, tmp_path):
    draw = random.Random(9)
    texts = ["Yes.", "No", " \t\n", None, "", "what?\r\n", " ", "x" * 30000 + "!", "é…", "a.b"]
    rows = [(draw.choice([None, -1, 3, 4, 5, 6, 7]), draw.choice([None, *range(-3, 40)]), draw.choice(["user", "assistant", "system", None, "", "User", "tool", "super"]), draw.choice(texts)) for _ in range(600)]
    # One conversation holds most rows, over several batches; another has one row again and again; one loses all its rows.
    rows += [(50, t, "user" if t % 2 else "assistant", f"turn {t % 700}.") for t in range(1500)] + [(51, 2, "user", "Again.")] * 400
    rows += [(k, 1, "user", "Gone.") for k in range(100, 160) if zlib.crc32(f"{k}:1".encode()) % 20 == 0]
    check(spark, rows, tmp_path)


def test_empty_table_and_edits(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    reports, edits = R.repair(none)
    assert reports.count() == edits.count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 1, "user", "There."), (1, 2, "system", "No")], "conv_id long, turn long, role string, text string")
    reports, edits = R.repair(rows.withColumn("conv", F.lit("mine")).withColumn("audit", F.lit(1)))
    assert [(r.cost, r.audit) for r in reports.collect()] == [(5, "KRDD")]
    assert [(r.place, r.edit, r.turn, r.role, r.text) for r in edits.orderBy("place").collect()][:2] == [(0, "K", 0, "user", "Hi."), (1, "R", 1, "assistant", "There.")]


def test_query_against_its_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    rel = con.sql(R.oracle_sql())
    want = sorted(tuple(r[rel.columns.index(c)] for c in ("conv_id", *COLUMNS)) for r in rel.fetchall())
    assert sorted(tuple(r[c] for c in ("conv_id", *COLUMNS)) for r in R.query(spark, sf_dir).collect()) == want
