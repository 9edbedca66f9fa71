"""Periodic runs against a plain search for every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tablewright.llm")

from tablewright.llm import periodic_runs as R  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(12, 2 * q) and not any(s <= start and s + m >= end for s, m, _ in found):
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences():
    draw = random.Random(3)
    yield from ([], [1] * 11, [1] * 12, [1] * 300, [1, 2] * 6, [1, 2, 3, 4, 5, 6] * 2, fibonacci(400), ([1] * 40 + [2]) * 7, ([1, 2, 3] * 20 + [4]) * 3)
    for letters in (2, 3, 20):
        for _ in range(25):
            yield [draw.randrange(letters) for _ in range(draw.randrange(10, 260))]
    for _ in range(60):
        q = draw.randrange(1, 90)
        unit = [draw.randrange(60) for _ in range(q)]
        middle = (unit * 12)[: draw.randrange(q, 9 * q)]
        yield [draw.randrange(60) for _ in range(draw.randrange(40))] + middle + [draw.randrange(60) for _ in range(draw.randrange(40))] + middle[: draw.randrange(1, len(middle) + 1)]


def test_runs_of_numbers():
    for x in sequences():
        assert [tuple(r) for r in R.runs_of(np.array(x, np.int64)).tolist()] == plain_runs(x)


def test_texts_end_to_end():
    texts = [[str(v).encode() for v in x] for x in sequences()]
    runs, text = R.group_runs(texts)
    for k, words in enumerate(texts):
        assert [tuple(r) for r in runs[text == k].tolist()] == plain_runs(words)


def test_transform_is_exact():
    draw = np.random.default_rng(1)
    for prime, generator in R.PRIMES:
        a, b = draw.integers(0, prime, (2, 3, 16), dtype=np.uint64)
        got = R.transform(R.modulo(R.transform(a, prime, generator) * R.transform(b, prime, generator), prime), prime, generator, inverse=True)
        want = [[sum(int(x[i]) * int(y[(k - i) % 16]) for i in range(16)) % prime for k in range(16)] for x, y in zip(a, b, strict=True)]
        assert (R.modulo(got * np.uint64(pow(16, -1, prime)), prime) == np.array(want, np.uint64)).all()


def expected(rows):
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query(spark, sf_dir, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text is None or len(r.text) < 4000]
    ten = [k for k in range(5000, 5400) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows += [(None, "a " * 40), (-5, None), (7001, ""), (7002, " \t\n"), (7003, "x\x1cy\xa0z \x0b" * 30), (7003, "x\x1cy\xa0z \x0b" * 30), (7004, "ab " * 900)]
    rows += [(k, t) for k, t in zip(ten, ["one", "", None, "one two", " ".join(map(str, range(150))), "  lead and trail \n" * 9, "\x85 é ü"], strict=False)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = R.query(spark, str(tmp_path))
    assert got.columns == list(COLUMNS)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_collapsed_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "so " + "la la li " * 6 + "end", "mine")], "doc_id long, text string, runs string")
    row = R.find_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 18, 3)]
    assert row.collapsed == "so la la li end"
    assert R.find_runs(docs.where("doc_id = 2")).count() == 0
