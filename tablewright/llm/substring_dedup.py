"""Substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes: each step shifts the hash left and adds a fixed random number for the byte, so it depends
on the last 32 bytes only. A chunk ends where the masked hash is zero, at MOST bytes at the latest and not before LEAST.
Text inserted in front of a passage moves its bytes but not its borders, so equal passages fall into equal chunks after
the first border. Each chunk is known by its digest; the document with the smallest doc_id that holds it owns it.

A chunk is repeated in a document if a document with a smaller doc_id owns it. Neighbouring repeated chunks make a run. A passage begins and ends within chunks that
differ, so each run is extended byte by byte to both sides, up to REACH bytes, as far as the text there equals what stands beside the same chunk in its owner.
Extended runs of at least SPAN bytes are removed, and runs of any length that are a whole document; other short ones are chance.

Digests are grouped with partial aggregates within tasks, so a chunk that a third of
all documents share costs a row per task; the owners of the commonest chunks are broadcast (fewer than a thousand), so their rows meet in no task.
Documents meet their repeated chunks by id, never each other. The places that runs ask an owner about are counted and made distinct before they meet its text, so an owner
whose passage very many documents repeat is asked once for each of its places, and its answers are dealt out like the commonest chunks.

Null text counts as empty and keeps nothing. Rows with a null id own nothing and lose nothing. Repeated rows of one id are
handled each and never repeat one another. Repeats within one document stay. Empty texts have no chunk; an empty table gives no row. A very long
text is cut whole, one at a time. Of a tie the smallest id owns the chunk, at its first place. Other columns of the caller are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, join_hot, map_batches, table, written

LEAST, MOST, SPAN = 24, 192, 96
#: Bytes that a run is extended by to either side at most: the longest chunk, the bytes that a border looks back on, and some to spare.
REACH = 256
#: A border is where these bits of the gear hash are zero: one in 32 places.
MASK = np.uint32(0x1F << 27)
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def borders(raw: bytes, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of a text."""
    n = len(raw)
    if not n:
        return []
    h = GEAR[np.frombuffer(raw, np.uint8)]
    for shift in (1, 2, 4, 8, 16):  # the sum over the last 32 bytes, by doubling
        h[shift:] += h[:-shift] << np.uint32(shift)
    ends, last = [], 0
    for end in (np.flatnonzero((h & MASK) == 0) + 1).tolist():
        while end - last > most:
            last += most
            ends.append(last)
        if end - last >= least:
            ends.append(end)
            last = end
    while n - last > most:
        last += most
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def row_key() -> F.Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64("text")


def chunk_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, start, size, hi, lo: one row for each chunk; hi and lo are halves of its digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, size, digest = [], [], [], []
            for k, raw in enumerate(batch.column("raw").to_pylist()):
                ends = borders(raw or b"")
                begins = [0, *ends[:-1]] if ends else []
                row += [k] * len(ends)
                start += begins
                size += [e - b for b, e in zip(begins, ends, strict=True)]
                digest += [xxhash.xxh3_128_digest(raw[b:e]) for b, e in zip(begins, ends, strict=True)]
            halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            take = pa.array(row, pa.int32())
            columns = [batch.column("doc_id").take(take), batch.column("row_key").take(take), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "start", "size", "hi", "lo"])

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", row_key().alias("row_key"), F.col("text").cast("binary").alias("raw"))
    return map_batches(rows, cut, "doc_id long, row_key long, start int, size int, hi long, lo long")


ENDS = "doc_id long, row_key long, start int, stop int, l_owner long, l_key long, l_at long, r_owner long, r_key long, r_at long"


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, start, stop: the runs of each row's chunks that smaller doc_ids own, with the owner of the first and of the last chunk and where that chunk
    begins (l_at) or ends (r_at) in it."""
    chunks = chunk_rows(docs)  # cut once for each pass: that costs less than writing the chunks down
    place = F.struct("doc_id", "row_key", "start")
    owners = chunks.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first.doc_id < last")
    owners = owners.select("hi", "lo", "n", F.col("first.doc_id").alias("owner"), F.col("first.row_key").alias("key"), F.col("first.start").alias("at"))
    again = join_hot(chunks, checkpointed(owners), ["hi", "lo"], "n").where("owner < doc_id")
    own = again.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set(F.struct("start", "size", "owner", "key", "at"))).alias("chunks"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, row_key, chunks in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row_key", "chunks")), strict=True):
                first = last = None
                for c in chunks:
                    if last is None or last["start"] + last["size"] != c["start"]:
                        if last is not None:
                            out.append((doc_id, row_key, first["start"], last["start"] + last["size"], first["owner"], first["key"], first["at"], last["owner"], last["key"], last["at"] + last["size"]))
                        first = c
                    last = c
                if last is not None:
                    out.append((doc_id, row_key, first["start"], last["start"] + last["size"], first["owner"], first["key"], first["at"], last["owner"], last["key"], last["at"] + last["size"]))
            names, kinds = zip(*(c.split() for c in ENDS.split(", ")), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if k == "long" else pa.int32()) for i, k in enumerate(kinds)], list(names))

    return map_batches(own, join, ENDS)


def beside(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """owner, key, at, left, n, near: what stands before (left) or behind the places in owners that runs ask about, and how many ask."""
    asked = [runs.select(*[F.col(f"{s}_{c}").alias(c) for c in ("owner", "key", "at")], F.lit(s == "l").alias("left")) for s in "lr"]
    asked = asked[0].unionByName(asked[1]).groupBy("owner", "key", "at", "left").agg(F.count("*").alias("n"))
    asked = asked.groupBy(F.col("owner").alias("doc_id"), F.col("key").alias("row_key")).agg(F.collect_list(F.struct("at", "left", "n")).alias("asked"))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", row_key().alias("row_key"), F.col("text").cast("binary").alias("raw")).join(asked, ["doc_id", "row_key"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            for k, (raw, asked) in enumerate(zip(batch.column("raw").to_pylist(), batch.column("asked").to_pylist(), strict=True)):
                row += [k] * len(asked)
                out += [(a["at"], a["left"], a["n"], raw[max(0, a["at"] - REACH) : a["at"]] if a["left"] else raw[a["at"] : a["at"] + REACH]) for a in asked]
            take = pa.array(row, pa.int32())
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.bool_(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("row_key").take(take), *columns], ["owner", "key", "at", "left", "n", "near"])

    # Rows that are the same in all columns ask and answer alike.
    return map_batches(texts, answer, "owner long, key long, at long, left boolean, n long, near binary").groupBy("owner", "key", "at", "left").agg(F.max("n").alias("n"), F.max("near").alias("near"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, runs: (start, stop, before, behind) of each row's runs, with what stands beside their first and last chunk in the owners."""
    runs = written(repeated_runs(docs), "substring-runs")
    near = written(beside(docs, runs), "substring-near")
    for s, name in (("l", "before"), ("r", "behind")):
        side = near.where(F.col("left") == (s == "l")).select(*[F.col(c).alias(f"{s}_{c}") for c in ("owner", "key", "at")], "n", F.col("near").alias(name))
        runs = join_hot(runs, side, [f"{s}_owner", f"{s}_key", f"{s}_at"], "n")
    return runs.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "before", "behind"))).alias("runs"))


def shared_end(a: bytes, b: bytes) -> int:
    """How many bytes two texts end on in common."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a[len(a) - n :], np.uint8) != np.frombuffer(b[len(b) - n :], np.uint8))
    return n - 1 - int(differ[-1]) if len(differ) else n


def extended(raw: bytes, runs: list[tuple[int, int, bytes, bytes]]) -> list[tuple[int, int]]:
    """The runs with what they share with their owners on either side, joined where they meet."""
    out: list[list[int]] = []
    for start, stop, before, behind in runs:
        start -= shared_end(raw[max(0, start - REACH) : start], before or b"")
        stop += shared_end(raw[stop : stop + REACH][::-1], (behind or b"")[::-1])
        if out and start <= out[-1][1]:
            out[-1] = [min(start, out[-1][0]), max(stop, out[-1][1])]
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def spans_of(runs: list[tuple[int, int]], span: int = SPAN, whole: int = -1) -> list[tuple[int, int]]:
    """The runs of at least `span` bytes, or of all `whole` bytes of the text."""
    return [(a, b) for a, b in runs if b - a >= span or b - a == whole]


def dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text (bytes that no longer form a letter are dropped)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    joined = docs.withColumn("row_key", row_key()).join(repeated_spans(docs), ["doc_id", "row_key"], "left")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for raw, runs in zip(batch.column("raw").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                spans = spans_of(extended(raw, [(r["start"], r["stop"], r["before"], r["behind"]) for r in runs or []]), whole=len(raw))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                for values, v in zip(out, (len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_text else None), strict=True):
                    values.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(out, types, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    out = map_batches(joined.select("doc_id", F.col("text").cast("binary").alias("raw"), "runs"), apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return out if with_text else out.drop("kept_text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
