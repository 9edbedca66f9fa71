"""Best-fit packing of token sequences by a configuration linear program.

Documents are tokenized, closed with an end token and cut into pieces of at most `capacity` tokens. Packing
depends only on how many pieces there are of each length, a histogram of at most `capacity` numbers however
large the corpus is. The program over all ways to fill one sequence (its configurations) is

    minimise the number of sequences, so that each length is covered as often as it occurs.

It has far too many columns to write down. Multiplicative weights keep one price for each length; a knapsack
dynamic program finds the most valuable configuration at those prices; the prices of the lengths in it fall,
and the average of the configurations found solves the program approximately. The fractions are rounded down
so that no length is used more often than it occurs, and the rest is packed best-fit over the histogram.

The plan (configuration, number of copies) becomes slots: for each length, runs of equal slots. Pieces are
numbered within their length without gathering a length in one task (a salted rank plus the offsets of the
salts), and the number decides the slot.

Null text counts as empty: one piece that holds the end token alone. Repeated rows are packed each; rows with
a null id as well. Ties between equal lengths are broken by id and piece, which changes no sequence's size. A very long text is tokenized whole
and gives as many pieces as it needs. An empty table gives no piece. Other columns of the caller are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import Numbering, checkpointed, kept_by_worker, map_batches, table

CAPACITY = 1024
END_ID = 2
#: Words whose ids a task remembers at most; then it forgets all.
REMEMBERED = 600_000
#: Salts of the rank within a length: one for so many pieces, and this many at least.
ROWS_PER_SALT, LEAST_SALTS = 20_000, 256
ROUNDS, RATE = 800, 0.1


def byte_values() -> dict[str, int]:
    """The letters that byte-level BPE files write for the 256 bytes: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Ids:
    """Token ids of whole texts, as `tokenizers` gives them for a byte-level BPE file.

    A space and the word behind it are never merged with what stands before them (the pattern of byte-level
    BPE starts a token at that space), so a word is encoded once and remembered by its number; a text is then
    a gather. Single words go through tiktoken with the file's own vocabulary, which costs less for each call.
    Texts with special tokens or unusual white space take the plain way through `tokenizers`.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte = byte_values()
        ranks = {bytes(byte[c] for c in word): i for word, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if word not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.word = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbering()
        self.at, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self.clear()
        parts = []
        for text in texts:
            head, *words = text.split(" ")
            # A space that stands before white space, or ends the text, belongs to no word.
            odd = not words or "" in words or any(w[0].isspace() for w in set(words)) or any(s in text for s in self.special)
            parts.append((text, None) if odd else (head, np.array(self.numbers.of(words))))
        if self.numbers.new:
            ids = [self.word.encode_ordinary(" " + w) for w in self.numbers.new]
            self.numbers.new = []
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(x) for x in ids])])
            self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], np.uint32)])
        for head, index in parts:
            first = self.encode(head) if head else self.flat[:0]
            if index is None:
                yield first
                continue
            start, size = self.at[index], self.at[index + 1] - self.at[index]
            ahead = np.cumsum(size)
            yield np.concatenate([first, self.flat[np.repeat(start - ahead + size, size) + np.arange(ahead[-1])]])


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: only texts of over `capacity` ids are cut; all pieces but the first are full."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_by_worker(("ids", tokenizer), lambda: Ids(tokenizer))
        for batch in batches:
            out: list[list[int | None]] = [[], [], [], [], []]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                    end = first if k == 0 else start + capacity
                    for values, v in zip(out, (doc_id, k, start, end - start, zlib.crc32(ids[start:end].tobytes())), strict=True):
                        values.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_configuration(prices: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack: how often each length stands in the most valuable filling, never oftener than it occurs.

    `prices` and `counts` by length, from 0. The table goes over capacities; one step looks at all lengths at
    once. The way back takes a length at most as often as it occurs; what that leaves free is filled greedily.
    """
    lengths = np.flatnonzero(counts)
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    worth = prices[lengths]
    for c in range(1, capacity + 1):
        fit = np.searchsorted(lengths, c, "right")
        value[c] = value[c - 1]
        if fit:
            options = value[c - lengths[:fit]] + worth[:fit]
            k = int(options.argmax())
            if options[k] > value[c]:
                value[c], choice[c] = options[k], lengths[k]
    used, c = np.zeros(len(counts), int), capacity
    free = 0
    while c > 0:
        k = choice[c]
        if not k:
            c, free = c - 1, free + 1
        else:
            c -= k
            if used[k] < counts[k]:
                used[k] += 1
            else:
                free += k
    for k in lengths[::-1]:
        n = min(free // k, counts[k] - used[k])
        used[k] += n
        free -= n * k
    return used


def solve(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """An approximate fractional solution: configurations and how many sequences take each."""
    left = counts.copy()
    left[0] = left[capacity] = 0
    lengths = np.flatnonzero(left)
    if not len(lengths):
        return []
    prices = np.zeros(capacity + 1)
    prices[lengths] = lengths / capacity
    found: dict[bytes, list] = {}
    covered = np.zeros(capacity + 1)
    for _ in range(rounds):
        use = best_configuration(prices, left, capacity)
        # As many sequences as the scarcest length in it allows.
        used = np.flatnonzero(use)
        amount = (left[used] / use[used]).min()
        entry = found.setdefault(use.tobytes(), [use, 0.0])
        entry[1] += amount
        covered[used] += amount * use[used]
        prices[used] *= np.exp(-RATE * amount * use[used] / left[used])
    # Scaled to the volume there is. Rounding never uses a length more often than it occurs.
    scale = (left * np.arange(capacity + 1)).sum() / (covered * np.arange(capacity + 1)).sum()
    return [(use, x * scale) for use, x in found.values()]


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Best-fit over the histogram: the longest length left opens a sequence, and what fits best joins it;
    a filling is repeated as often as the counts allow."""
    left, plan = counts.copy(), []
    left[0] = 0
    while left.any():
        use, free = np.zeros(capacity + 1, int), capacity
        while free > 0:
            fits = np.flatnonzero(left[: free + 1] - use[: free + 1] > 0)
            if not len(fits):
                break
            use[fits[-1]] += 1
            free -= fits[-1]
        used = np.flatnonzero(use)
        times = int((left[used] // use[used]).min())
        left[used] -= times * use[used]
        plan.append((use, times))
    return plan


def plan_sequences(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """Whole configurations with whole numbers of copies that use each length exactly as often as it occurs."""
    left = counts.astype(np.int64)
    left[0] = 0
    plan = []
    if left[capacity]:
        full = np.zeros(capacity + 1, int)
        full[capacity] = 1
        plan.append((full, int(left[capacity])))
        left[capacity] = 0
    for use, x in sorted(solve(left, capacity), key=lambda p: -p[1]):
        used = np.flatnonzero(use)
        times = int(min(np.floor(x + 1e-9), (left[used] // use[used]).min()))
        if times > 0:
            left[used] -= times * use[used]
            plan.append((use, times))
    return plan + best_fit(left, capacity)


def slots_of(plan: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number of slots, first sequence, offset): runs of slots of equal length and offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for use, times in plan:
        offset = 0
        for length in np.flatnonzero(use)[::-1]:
            for _ in range(use[length]):
                rows.append((int(length), taken.get(length, 0), times, sequence, offset))
                taken[length] = taken.get(length, 0) + times
                offset += int(length)
        sequence += times
    return rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset. `pieces` must give the same rows when read again (a table or a checkpoint)."""
    spark = pieces.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    slots = slots_of(plan_sequences(counts, capacity))
    salts = max(LEAST_SALTS, int(counts.sum()) // ROWS_PER_SALT)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt").count().withColumn("ahead", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("ahead"))
    # One short sorted array of slot runs for each length; its size depends on the plan, not on the rows.
    runs = (
        spark.createDataFrame(slots, "length long, first long, n long, sequence long, offset long")
        .groupBy("length")
        .agg(F.sort_array(F.collect_list(F.struct("first", "n", "sequence", "offset"))).alias("runs"))
    )
    run = F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["first"] + r["n"]))[0]
    return ranked.join(F.broadcast(runs), "length").withColumn("run", run).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("run.sequence") + F.col("rank") - F.col("run.first")).alias("sequence_id"), F.col("run.offset").alias("offset")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(checkpointed(pieces_of(docs, tokenizer, capacity, end_id)), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the place of every piece of every document."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
