"""Benchmark decontamination by template windows.

Texts become sequences of template tokens, cut at white space and around each letter of a script that is written without
spaces: numbers, names (a capitalised word inside a sentence) and units (behind a number) turn into typed placeholders,
other words into their lower-case letters and digits. A capitalised word that starts a sentence can be a name or not, so a
window that holds one is hashed in both readings. Windows of WINDOW template tokens are hashed on both sides and joined; those
with few words of their own are hashed with their slot values as well, those without any only with these. Items shorter
than a window are one window of their own size; items shorter than SHORTEST tokens match by their values only. Items of fewer than LEAST_DROPPED tokens (`yes`, a name) stand in clean text
by chance: they are listed, and no document is dropped for them.

A joined window gives an alignment of item and document, along which every window of the item is compared, token by
token, and binds each slot of the item to a value of the document. The binding must be a one-to-one mapping: the same value always
becomes the same value. Windows whose slots contradict the mapping are not counted. Where the windows counted hold fewer
than LITERALS words between them, the template says too little and only windows with equal values count.
A document contains an item if the windows counted cover at least COVERAGE of the item's. `exact` says that
every slot kept its value; otherwise the question was given other parameters.

The benchmark is read in blocks of a checked size (characters), each of which is sent to the tasks and probed by every
document; a benchmark of one block, as usual, needs one pass. No document is ever shuffled or paired with another.

Null or empty texts and items match nothing. Repeated documents are judged each; a repeated item id with different texts
counts as items of the same id. An empty benchmark leaves every document clean; an empty table gives no row. Very long texts are read whole. Ties: all
items that a document contains are given, in order of id. The caller's own column named items is replaced, all others stay.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import Numbering, kept_by_worker, map_batches, table

WINDOW, LITERALS, SHORTEST, COVERAGE = 8, 5, 5, 0.5
#: Tokens of the shortest item that a document is dropped for.
LEAST_DROPPED = 3
#: Characters of benchmark text in one block.
BLOCK_CHARS = 20_000_000
REMEMBERED = 600_000
#: Words that are units behind a number.
UNITS = frozenset("mm cm m km in ft mi mg g kg lb oz ml l s sec min h hr hour hours minute minutes day days week weeks year years usd eur dollars euros percent % kmh mph meters metres kilometers miles feet inches grams kilograms pounds liters litres degrees".split())
WORD, NUMBER, NAME, UNIT, BREAK = range(5)
NUMERIC = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
CORE = re.compile(r"[^\W_]+")
#: Letters of scripts without spaces between words: each is a token.
UNSPACED = re.compile("([\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
#: Stands for the end of a line.
LINE = "\0"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def hash64(s: str) -> int:
    raw = s.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5BD1E995)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Templates:
    """Template tokens of texts. Words are looked at once and remembered by number."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.numbers, self.values, self.facts = Numbering(), np.zeros(0, np.uint64), np.zeros((0, 4), np.uint8)

    @staticmethod
    def fact(word: str) -> tuple[int, int, int, int, int]:
        """(kind, value, may be a name, may be a unit, ends a sentence)"""
        core = "".join(CORE.findall(word))
        ends = word[-1] in ".!?:" or word[-2:-1] in (".", "!", "?")
        if word == LINE or not core:
            return BREAK, 0, 0, 0, int(word == LINE or ends)
        bare = word.strip(".,;:!?\"'()[]")
        if NUMERIC.fullmatch(bare):
            return NUMBER, hash64(bare), 0, 0, int(ends)
        name = core[0].isupper() and len(core) > 1 and core[1:].islower()
        return WORD, hash64(core.lower()), int(name), int(core.lower() in UNITS), int(ends)

    @staticmethod
    def words_of(text: str) -> list[str]:
        if not text.isascii():
            text = UNSPACED.sub(r" \1 ", text)
        return text.replace("\n", f" {LINE} ").split()

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, value hash, is a word that may be a name) of each token, for each text."""
        if len(self.numbers) > REMEMBERED:
            self.clear()
        indices = [np.array(self.numbers.of(self.words_of(t or "")), np.int64) for t in texts]
        if self.numbers.new:
            new = np.array([self.fact(w) for w in self.numbers.new], np.uint64)
            self.values, self.facts = np.concatenate([self.values, new[:, 1]]), np.concatenate([self.facts, new[:, [0, 2, 3, 4]].astype(np.uint8)])
            self.numbers.new = []
        for index in indices:
            value = self.values[index]
            kind, name, unit, ends = self.facts[index].T
            start = np.r_[True, ends[:-1] > 0][: len(kind)]
            # A token without letters passes a sentence's end on.
            keep = kind != BREAK
            if not keep.all():
                last = np.maximum.accumulate(np.where(keep | (ends > 0), np.arange(len(kind)), -1))
                before = np.r_[-1, last[:-1]]
                start = (before < 0) | (ends[np.maximum(before, 0)] > 0)
            kind, value, name, unit, start = (x[keep] for x in (kind, value, name, unit, start))
            kind = kind.astype(np.int64)
            kind[(name > 0) & ~start] = NAME
            kind[(unit > 0) & (np.r_[False, kind[:-1] == NUMBER] if len(kind) else np.zeros(0, bool))] = UNIT
            yield kind, value, (name > 0) & (kind == WORD)


def literals(size: int) -> int:
    """Words that a window of `size` tokens must hold to say enough as a template."""
    return max(1, size * LITERALS // WINDOW)


def held(x: np.ndarray, size: int) -> np.ndarray:
    """How many of each `size` neighbours are true."""
    sums = np.r_[0, np.cumsum(x)]
    return sums[size:] - sums[:-size]


def windows(kind: np.ndarray, value: np.ndarray, maybe: np.ndarray, size: int = WINDOW, item: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each reading of each window of `size` tokens: as it stands, with words that may be names as names,
    and by value. An item's windows are all hashed by value; a document's where few of its words are surely words."""
    n = len(kind) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rolled(x: np.ndarray) -> np.ndarray:
        h = np.zeros(n, np.uint64)
        for j in range(size):
            h = h * MULTIPLIER + x[j : j + n]
        return h

    def by_value() -> np.ndarray:
        return rolled(mixed(value + np.uint64(1))) ^ np.uint64(0x5555555555555555)

    if size < SHORTEST:
        return mixed(by_value() + np.uint64(size)), np.arange(n)
    slots = kind.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    plain = np.where(kind == WORD, mixed(value), slots)
    words = held(kind == WORD, size)
    at = [np.flatnonzero(words > 0)]
    parts, sure = [rolled(plain)[at[0]]], words
    if maybe.any():
        names, names_as = held(maybe, size), np.array([NAME], np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        sure = words - names
        at.append(np.flatnonzero((names > 0) & (sure > 0)))
        parts.append(rolled(np.where(maybe, names_as, plain))[at[1]])
    # A copy's first word can be surely a word where the item's may be a name, so the document's side allows one more.
    few = np.arange(n) if item else np.flatnonzero(sure <= literals(size))
    if len(few):
        at.append(few)
        parts.append(by_value()[few])
    return mixed(np.concatenate(parts) + np.uint64(size)), np.concatenate(at)


class Index:
    """The windows of a block of benchmark items, sorted by hash."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items = [(i, *t) for (i, _), t in zip(items, Templates()([t for _, t in items]), strict=True)]
        self.tokens: dict[int, int] = {}  # of an id, the most that a text of it has
        for i, kind, *_ in self.items:
            self.tokens[i] = max(self.tokens.get(i, 0), len(kind))
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        rows = defaultdict(list)
        self.n_windows = []
        for k, (_, kind, value, maybe) in enumerate(self.items):
            size = min(WINDOW, len(kind))
            h, j = windows(kind, value, maybe, size, item=True) if size else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            self.n_windows.append(len(kind) - size + 1 if size else 0)
            rows[size].append((h, np.full(len(h), k), j))
        for size, parts in rows.items():
            h, k, j = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            if len(h):
                self.sizes[size] = (h[order], k[order], j[order])

    def compared(self, k: int, shift: int, kind: np.ndarray, value: np.ndarray, maybe: np.ndarray) -> tuple[set[int], dict[tuple[int, int], int]]:
        """Windows of item k that count where its token 0 stands at token `shift` of the text, and the values that its slots are bound to."""
        _, item_kind, item_value, item_maybe = self.items[k]
        size = min(WINDOW, len(item_kind))
        first, end = max(0, -shift), min(len(item_kind), len(kind) - shift)
        if end - first < size:
            return set(), {}
        mine, theirs = slice(first, end), slice(shift + first, shift + end)
        c, a, b = item_kind[mine], item_value[mine], value[theirs]
        same = a == b
        if size < SHORTEST:
            return {first + int(j) for j in np.flatnonzero(held(same, size) == size)}, {}
        literal = same & (c == WORD) & (kind[theirs] == WORD)
        named = ((c == NAME) | item_maybe[mine]) & ((kind[theirs] == NAME) | maybe[theirs])
        fits = literal | named | ((c == kind[theirs]) & (c != WORD))
        c = np.where(named, NAME, c)
        said = np.zeros(len(c), bool)
        there, back, counted = {}, {}, []
        for j in np.flatnonzero(held(fits, size) == size).tolist():
            to, of, agrees = {}, {}, True
            for d in range(j, j + size):
                if not literal[d]:
                    x, y = (int(c[d]), int(a[d])), (int(c[d]), int(b[d]))
                    if to.setdefault(x, there.get(x, y)) != y or of.setdefault(y, back.get(y, x)) != x:
                        agrees = False
                        break
            if agrees:
                there |= to
                back |= of
                counted.append(j)
                said[j : j + size] |= literal[j : j + size]
        if said.sum() < literals(size):
            counted = [j for j in counted if same[j : j + size].all()]
            there = {(int(c[d]), int(a[d])): (int(c[d]), int(b[d])) for j in counted for d in range(j, j + size) if not literal[d]}
        return {first + j for j in counted}, {x: y for x, (_, y) in there.items()}

    def found(self, kind: np.ndarray, value: np.ndarray, maybe: np.ndarray) -> list[tuple[int, int, int, int, bool]]:
        """(item id, windows counted, windows of the item, slots bound, exact) of each item that the text contains."""
        hits: dict[int, set[int]] = defaultdict(set)
        for size, (h, k, j) in self.sizes.items():
            own, place = windows(kind, value, maybe, size)
            if not len(own):
                continue
            at = np.searchsorted(h, own)
            for i in np.flatnonzero(h[np.minimum(at, len(h) - 1)] == own):
                for q in range(at[i], len(h)):
                    if h[q] != own[i]:
                        break
                    hits[int(k[q])].add(int(place[i] - j[q]))
        out = []
        for k, shifts in sorted(hits.items()):
            counted, slots, exact = set(), set(), True
            for shift in sorted(shifts):
                own, bound = self.compared(k, shift, kind, value, maybe)
                counted |= own
                slots |= {(c, a, b) for (c, a), b in bound.items()}
                exact &= all(a == b for (_, a), b in bound.items())
            if counted and len(counted) >= COVERAGE * self.n_windows[k]:
                out.append((int(self.items[k][0]), len(counted), self.n_windows[k], len(slots), bool(exact)))
        return out


def blocks_of(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of about `block_chars` characters, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-chars // block_chars)
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, items: an array of (item_id, n_windows, of_windows, n_slots, exact, n_tokens), for every row of `docs`; other columns stay."""
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "items"])
    kind = "array<struct<item_id:bigint,n_windows:int,of_windows:int,n_slots:int,exact:boolean,n_tokens:int>>"
    out = docs.withColumn("items", F.array().cast(kind))
    at = [c.lower() for c in docs.columns].index("text")
    for block in blocks_of(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            index, templates = kept_by_worker(("benchmark", zlib.crc32(repr(block).encode("utf-8", "surrogatepass"))), lambda: (Index(block), Templates()))
            struct = pa.struct([("item_id", pa.int64()), ("n_windows", pa.int32()), ("of_windows", pa.int32()), ("n_slots", pa.int32()), ("exact", pa.bool_()), ("n_tokens", pa.int32())])
            names = [f.name for f in struct]
            for batch in batches:
                found = [[dict(zip(names, (*x, index.tokens[x[0]]), strict=True)) for x in index.found(*t)] for t in templates(batch.column(at).to_pylist())]
                old = batch.column(len(batch.schema) - 1).to_pylist()
                items = pa.array([(a or []) + b for a, b in zip(old, found, strict=True)], pa.list_(struct))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], items], batch.schema.names)

        out = map_batches(out, probe, out.schema)
    return out


def clean(items: Column, least_tokens: int = LEAST_DROPPED) -> Column:
    """No item of so many tokens is contained."""
    return ~F.exists(items, lambda i: i["n_tokens"] >= least_tokens)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: the items that it contains, and kept = none that a document is dropped for."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.size("items").alias("n_items"), clean(F.col("items")).alias("kept"), F.transform("items", lambda x: x["item_id"]).alias("item_ids"), F.to_json("items").alias("evidence"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that contain no item of LEAST_DROPPED tokens or more."""
    return matches(docs, table(spark, sf_dir, "benchmark")).where(clean(F.col("items"))).select(*docs.columns)
