"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with a smallest period q, at least twice as long as q and LEAST words long, that no neighbour extends. All
runs of a text are found, of any period up to half the text.

Scales are dyadic. At scale B every run with a period between 2B - 1 and 4B - 2 holds a block of B words, at a multiple of B, whose words stand again q words
on. (The lowest scale takes blocks of 4 at every second word and periods 1 to 14.) So each block is looked for in the window behind it: with words as
numbers, the sum of squared differences of block and window at every shift is a convolution, worked out exactly by number-theoretic
transforms modulo as many primes as its largest value asks for. A sum of zero is an occurrence, and its distance a period to extend to both sides.
Blocks are only convolved if each four consecutive words of theirs come again within the window's reach, which an occurrence implies.

Seeds are taken by rising period. A stretch of period q that lies within a run of a smaller period is no run of q. A seed that lies within a run of period
p <= B is left out at once: block and occurrence then span p + q words or more, so q is a multiple of p and nothing longer grows from it (Fine and Wilf).

Texts of one Arrow batch are laid end to end with a number of its own between them, so one set of array operations serves them all and nothing
matches across. On Spark this is a map without a shuffle; a text needs some hundred bytes of memory a word.

Words are runs of anything but space and the controls 9 to 13. Null and empty texts have no word and no run. Null ids pass through. Repeated rows are
each done. Ties for the longest run go to the smallest start, then period. Empty tables give empty results; other columns of the
caller are not read. A text of very many words is done whole, its blocks in slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import Numbering, kept_by_worker, map_batches, table

LEAST = 12
SPACES = " \t\n\x0b\x0c\r"
#: Primes below 2 ** 31 with roots of unity for lengths to 2 ** 25 and more, and a generator of each.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Numbers in one slice of blocks that are transformed together, and words laid end to end.
SLICE, TOGETHER = 1 << 18, 200_000
FAR = np.int64(1) << 40


def modulo(values: np.ndarray, prime: int) -> np.ndarray:
    return values - values // np.uint64(prime) * np.uint64(prime)


def roots(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of that size; each worker works them out once."""
    held = kept_by_worker(("roots of unity",), dict)
    if (size, prime, inverse) not in held:
        held[size, prime, inverse] = powers_of_root(size, prime, generator, inverse)
    return held[size, prime, inverse]


def powers_of_root(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    root = pow(generator, (prime - 1) // size, prime)
    powers, step = np.ones(1, np.uint64), pow(root, -1, prime) if inverse else root
    while len(powers) < size // 2:
        powers = np.concatenate([powers, modulo(powers * np.uint64(step), prime)])
        step = step * step % prime
    return powers


def transform(rows: np.ndarray, prime: int, generator: int, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row, without the division by the size for the inverse. Sorts as it goes (Stockham)."""
    many, size = rows.shape
    half, stride, p = size // 2, 1, np.uint64(prime)
    while half:
        pair = rows.reshape(many, 2, half, stride)
        low, high = pair[:, 0], pair[:, 1]
        out = np.empty((many, half, 2, stride), np.uint64)
        total = low + high
        out[:, :, 0] = total - p * (total >= p)
        out[:, :, 1] = modulo((low + p - high) * roots(2 * half, prime, generator, inverse)[:, None], prime)
        rows, half, stride = out.reshape(many, size), half // 2, stride * 2
    return rows


def occurrences(x: np.ndarray, starts: np.ndarray, block: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of all occurrences of the blocks at `starts` between `low` and `high` words on. The numbers end with `high` + `block` that occur nowhere else."""
    reach = high - low + 1
    size = 1 << (reach + block - 2).bit_length()
    largest = int(x.max())
    primes, bound = [], 1
    for prime in PRIMES:
        if bound <= block * largest * largest:
            primes.append(prime)
            bound *= prime[0]
    found = []
    many = max(1, SLICE // size)
    for at in range(0, len(starts), many):
        own = starts[at : at + many]
        blocks = x[own[:, None] + np.arange(block)]
        windows = x[own[:, None] + np.arange(low, high + block)]
        squares = np.zeros((len(own), windows.shape[1] + 1), np.int64)
        np.cumsum(windows * windows, axis=1, out=squares[:, 1:])
        apart = (blocks * blocks).sum(1)[:, None] + squares[:, block : block + reach] - squares[:, :reach]
        zero = np.ones(apart.shape, bool)
        for prime, generator in primes:
            # Reversed, so that the product of the transforms is that of a correlation.
            one, two = np.zeros((2, len(own), size), np.uint64)
            one[:, -np.arange(block) % size] = blocks % prime
            two[:, : windows.shape[1]] = windows % prime
            product = modulo(transform(one, prime, generator) * transform(two, prime, generator), prime)
            sums = transform(product, prime, generator, inverse=True)[:, :reach]
            sums = modulo(sums * np.uint64(pow(size, -1, prime)), prime)
            zero &= modulo(sums * np.uint64(2), prime) == (apart % prime).astype(np.uint64)
        row, shift = np.nonzero(zero)
        found.append((own[row], shift + low))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def first_difference(x: np.ndarray, i: int, q: int, step: int) -> int:
    """The first place from i on, in steps of 1 or -1, where the word q further on is another one, or the end."""
    end, size = (len(x) - q, 64) if step > 0 else (-1, 64)
    while i != end:
        j = min(end, i + size) if step > 0 else max(end, i - size)
        a, b = (i, j) if step > 0 else (j + 1, i + 1)
        other = np.flatnonzero(x[a:b] != x[a + q : b + q])
        if len(other):
            return a + int(other[0] if step > 0 else other[-1])
        i, size = j, size * 2
    return end


def comes_again(x: np.ndarray) -> np.ndarray:
    """How far on each four consecutive words stand again; FAR if they don't. Words are compared by a hash, so it may be nearer than the truth."""
    key = x.astype(np.uint64)
    mixed = key[:-3].copy()
    for k in (1, 2, 3):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + key[k : len(key) - 3 + k]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    far = np.full(len(mixed), FAR)
    far[order[:-1][same]] = order[1:][same] - order[:-1][same]
    return far


def runs_of(numbers: np.ndarray, longest: int | None = None) -> np.ndarray:
    """(start, length, period) of all runs, by start and period. `longest`: no text among the numbers is longer."""
    n = len(numbers)
    longest = n if longest is None else longest
    if longest < LEAST:
        return np.zeros((0, 3), np.int64)
    far = comes_again(numbers)
    scales = [(4, 2, 1, 14)]
    while 2 * (2 * max(8, scales[-1][0] * 2) - 1) <= longest:
        block = scales[-1][0] * 2
        scales.append((block, block, 2 * block - 1, 4 * block - 2))
    padded = np.concatenate([numbers, np.full(scales[-1][3] + scales[-1][0], int(numbers.max()) + 1)])
    runs: list[tuple[int, int, int]] = []
    within = np.zeros(n + 1, np.int64)  # the furthest end of the runs found that begin here or before, as far as it is needed
    for block, stride, low, high in scales:
        count = (n - block - low) // stride + 1
        if count <= 0:
            break
        starts = np.arange(count) * stride
        inner = block - 3  # fours of words inside a block
        if stride == block:
            whole = far[: (len(far) // block) * block].reshape(-1, block)[:, :inner].max(1)
            again = np.full(count, FAR)
            again[: min(count, len(whole))] = whole[:count]
            for k in range(len(whole), count):
                again[k] = far[k * block : k * block + inner].max()
        else:
            again = far[starts]
        starts = starts[again <= high]
        if not len(starts):
            continue
        b, q = occurrences(padded, starts, block, low, high)
        small = np.array([(s, s + m) for s, m, p in runs if p <= block], np.int64).reshape(-1, 2)
        if len(small) and len(b):
            ends = np.zeros(n + 1, np.int64)
            np.maximum.at(ends, small[:, 0], small[:, 1])
            free = np.maximum.accumulate(ends)[b] < b + q + block
            b, q = b[free], q[free]
        order = np.lexsort((b, q))
        b, q = b[order], q[order]
        edges = np.flatnonzero(np.diff(q, prepend=-1, append=-1)).tolist()
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            own, period = b[i:j], int(q[i])
            k = 0
            while k < len(own):
                at = int(own[k])
                end = first_difference(numbers, at + block, period, 1) + period
                start = first_difference(numbers, at, period, -1) + 1
                if end - start >= max(LEAST, 2 * period) and within[start] < end:
                    runs.append((start, end - start, period))
                    within[start:end] = np.maximum(within[start:end], end)
                k = int(np.searchsorted(own, end - period - block, "right"))
    found = np.array(runs, np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def group_runs(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(runs, text): the runs of all texts with starts within their text, and the number of the text of each."""
    numbering = Numbering()
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1  # one number between texts
    x = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for begin, words in zip(begins.tolist(), texts, strict=True):
        x[begin : begin + len(words)] = numbering.of(words)
    x[begins + sizes] = len(numbering) + np.arange(len(texts))
    runs = runs_of(x, int(sizes.max(initial=0)))
    text = np.searchsorted(begins, runs[:, 0], "right") - 1
    runs[:, 0] -= begins[text]
    return runs, text


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period; by start and period) and collapsed: the words that no run repeats, joined by one space."""
    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = batch.column("doc_id"), batch.column("raw")
            a = 0
            while a < len(ids):
                texts, total = [], 0
                while a + len(texts) < len(ids) and (not texts or total < TOGETHER):
                    texts.append((raw[a + len(texts)].as_py() or b"").split())
                    total += len(texts[-1])
                runs, text = group_runs(texts)
                edges = np.searchsorted(text, np.arange(len(texts) + 1))
                left = []
                for k, words in enumerate(texts):
                    own = runs[edges[k] : edges[k + 1]]
                    if len(own):
                        over = np.zeros(len(words) + 1, np.int64)
                        np.add.at(over, own[:, 0] + own[:, 2], 1)
                        np.add.at(over, own[:, 0] + own[:, 1], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(over)[:-1] == 0)]
                    left.append(b" ".join(words))
                held = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([ids.slice(a, len(texts)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), held), pa.array(left, pa.binary())], ["doc_id", "runs", "collapsed"])
                a += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw"))
    return map_batches(rows, run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text; with h the crc32 of the id and g = h / 10: where h % 10 is 0, the words from g % n on repeat with a period of 1 + (words from there on) / (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, text = F.floor(h / 10), F.trim(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(SPACES))
    words = F.split(text, r"[\x20\x09-\x0D]+")
    at = lambda n: g % n
    period = lambda n: 1 + F.floor((n - at(n)) / (3 + g % 8))
    place = lambda i, n: F.when(i < at(n), i).otherwise(at(n) + (i - at(n)) % period(n))
    again = lambda w: F.array_join(F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, place(i, F.size(w)).cast("int"))), " ")
    # As the variable of an outer transform the words are split once, not once for each word.
    changed = F.when((h % 10 == 0) & (text != ""), F.transform(F.array(words), again)[0]).otherwise(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), changed.alias("text"))


def longest(runs: Column) -> Column:
    """The longest run; of several the first, then that of the smallest period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted(table(spark, sf_dir, "documents"))).withColumn("top", longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    size, period = F.col("top.length"), -F.col("top.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), size.alias("length"), period.alias("period"), F.floor(1000 * size / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
