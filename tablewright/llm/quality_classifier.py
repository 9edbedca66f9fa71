"""Quality by a convolutional network over bytes, in numpy.

A text is its UTF-8 bytes. Chunks of CHUNK bytes, STEP apart, cover all of it, so they overlap by more than a filter's width and every place that a filter
can look at lies within some chunk; the last one is filled up with zero bytes. In a chunk each byte has a learned vector; FILTERS learned
filters of WIDTH bytes pass over it, two bytes at a time; each filter's largest answer in the chunk is kept (max-pooling), a layer of HIDDEN
units reads these and gives the chunk's logit. A chunk whose filters find little to answer to (one word over and over) differs from prose just as
one with odd marks does. The mean, least and largest logit of all chunks are combined by a logistic fit into one probability.

The network is trained by Adam on a bounded sample: SAMPLE_GOOD and SAMPLE_BAD labelled documents at most, chosen by a hash of the id, and SAMPLE_CHUNKS
chunks of each at most, evenly spaced over the whole text and cut out on the executors, so the driver gets no more than a few MB whatever texts are
like. Every chunk inherits its document's label, and so do cut short copies of
each document's first chunk. The logistic fit is weighted to the shares of the labels in the table.

Predictions read every chunk of every text, in slices, so a very long text needs no more memory than its bytes. Only text is read: labels, lang, source
and doc_id never enter a score.

Null and empty texts are one chunk of zero bytes. Null labels, null ids and held-out ids are never learned from; of repeated labels of an id the lowest
counts. With labels of one kind only, all scores are that of a constant; without any, 0.5. Repeated rows are scored each; an empty table gives no row. Ties
in the sample go to the smaller id, then text. Other columns of the caller are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import map_batches, shared_value, table, value_of
from tablewright.llm.toxicity import logistic

CHUNK, STEP = 256, 192
VECTOR, WIDTH, FILTERS, HIDDEN = 8, 8, 24, 16
#: The sample: so many labelled documents of either kind, and chunks of each, at most.
SAMPLE_GOOD, SAMPLE_BAD, SAMPLE_CHUNKS = 1600, 800, 24
EPOCHS, BATCH, RATE = 8, 128, 4e-3
#: Chunks that are worked on at once when texts are scored.
SLICE = 192
PAIRS, TAPS = CHUNK // 2, WIDTH // 2


def chunk_count(size: int) -> int:
    return max(1, -(-(size - CHUNK) // STEP) + 1)


def chunks_of(raw: bytes, most: int | None = None) -> np.ndarray:
    """The chunks of a text, or `most` of them evenly spaced, as rows of bytes."""
    count = chunk_count(len(raw))
    at = np.arange(count) if most is None or count <= most else np.linspace(0, count - 1, most).round().astype(np.int64)
    held = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    held[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(held, CHUNK)[::STEP][at]


@dataclass
class Network:
    vectors: np.ndarray  # of each byte
    filters: np.ndarray  # pairs of bytes in a filter, numbers of a pair, filters
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def new(seed: int = 11) -> Network:
        draw = np.random.default_rng(seed)
        normal = lambda scale, *shape: draw.normal(0, scale, shape).astype(np.float32)
        zeros = lambda *shape: np.zeros(shape, np.float32)
        return Network(normal(0.5, 256, VECTOR), normal((WIDTH * VECTOR) ** -0.5 * 2, TAPS, 2 * VECTOR, FILTERS), zeros(FILTERS), normal(FILTERS**-0.5 * 1.4, FILTERS, HIDDEN), zeros(HIDDEN), normal(HIDDEN**-0.5, HIDDEN), zeros(1))

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def answers(self, chunks: np.ndarray) -> np.ndarray:
        """What each filter answers at every second byte: chunks, places, filters."""
        pairs = self.vectors[chunks].reshape(-1, 2 * VECTOR)
        # One product for all pairs of all filters; the pairs of one filter are then added side by side.
        every = (pairs @ self.filters.transpose(1, 0, 2).reshape(2 * VECTOR, -1)).reshape(len(chunks), PAIRS, TAPS, FILTERS)
        places = PAIRS - TAPS + 1
        total = every[:, :places, 0].copy()
        for k in range(1, TAPS):
            total += every[:, k : k + places, k]
        return total

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        found = []
        for a in range(0, len(chunks), SLICE):
            pooled = np.maximum(self.answers(chunks[a : a + SLICE]).max(1) + self.bias, 0)
            found.append(np.maximum(pooled @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias)
        return np.concatenate(found)

    def slopes(self, chunks: np.ndarray, labels: np.ndarray, care: np.ndarray) -> list[np.ndarray]:
        """The gradient of the weighted log loss, part by part."""
        answers = self.answers(chunks)
        best = answers.argmax(1)
        pooled = np.take_along_axis(answers, best[:, None], 1)[:, 0] + self.bias
        live = np.maximum(pooled, 0)
        inner = live @ self.hidden + self.hidden_bias
        shown = np.maximum(inner, 0)
        z = shown @ self.out + self.out_bias
        d = (care * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)).astype(np.float32)
        d_inner = np.outer(d, self.out) * (inner > 0)
        d_pooled = (d_inner @ self.hidden.T) * (pooled > 0)
        # Only the place of the largest answer has a share in it.
        seen = np.take_along_axis(chunks, (2 * best[:, :, None] + np.arange(WIDTH)).reshape(len(chunks), -1), 1).reshape(len(chunks), FILTERS, WIDTH)
        d_filters = np.einsum("cf,cfw->wf", d_pooled, self.vectors[seen].reshape(len(chunks), FILTERS, -1), optimize=True).reshape(TAPS, 2 * VECTOR, FILTERS)
        back = d_pooled[:, :, None, None] * self.filters.reshape(WIDTH, VECTOR, FILTERS).transpose(2, 0, 1)
        d_vectors = np.zeros_like(self.vectors)
        for k in range(VECTOR):
            d_vectors[:, k] = np.bincount(seen.ravel(), weights=back[..., k].ravel(), minlength=256)
        return [d_vectors, d_filters, d_pooled.sum(0), live.T @ d_inner, d_inner.sum(0), shown.T @ d, d.sum(keepdims=True)]


@dataclass
class Model:
    network: Network | None
    fit: np.ndarray  # logistic: constant, mean, least and largest logit

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The probability of each text."""
        if self.network is None:
            return np.full(len(texts), 1 / (1 + np.exp(-self.fit[0])))
        seen, waiting, size = [], [], 0
        for k, raw in enumerate(texts):  # short texts are worked on together, long ones in slices
            waiting.append(chunks_of(raw))
            size += len(waiting[-1])
            if size >= SLICE or k == len(texts) - 1:
                logits = self.network.logits(waiting[0] if len(waiting) == 1 else np.concatenate(waiting))
                seen.append(features(logits, [len(w) for w in waiting]))
                waiting, size = [], 0
        return 1 / (1 + np.exp(-np.clip(np.concatenate(seen) @ self.fit, -30, 30)))


def features(logits: np.ndarray, counts: list[int]) -> np.ndarray:
    """Constant, mean, least and largest logit of each text's chunks."""
    counts = np.array(counts)
    at = np.cumsum(counts) - counts
    logits = np.clip(logits, -20, 20)
    return np.column_stack([np.ones(len(counts)), np.add.reduceat(logits, at) / counts, np.minimum.reduceat(logits, at), np.maximum.reduceat(logits, at)])


def train(texts: list[np.ndarray], labels: list[int], shares: tuple[float, float] = (1.0, 1.0), epochs: int = EPOCHS) -> Model:
    """texts: the chunks of each. shares: documents of the table for each sampled one, of label 0 and of label 1."""
    y = np.array(labels, int)
    if len(set(labels)) < 2:
        return Model(None, np.array([0.0 if not labels else 30.0 if labels[0] else -30.0]))
    counts = [len(t) for t in texts]
    whole = np.concatenate(texts)
    network, draw = Network.new(), np.random.default_rng(12)
    # Short texts are few, so each document also gives its first chunk cut short twice.
    short = np.concatenate([np.stack([t[0] for t in texts])] * 2)
    short = short * (np.arange(CHUNK) < draw.integers(8, CHUNK // 2, len(short))[:, None])
    chunks, of = np.concatenate([whole, short]), np.r_[np.repeat(np.arange(len(texts)), counts), np.arange(len(texts)), np.arange(len(texts))]
    # Either label weighs a half, and a document's chunks weigh as much as the square root of their number.
    care = 1 / np.sqrt(np.array(counts) + 2)[of]
    for label in (0, 1):
        care[y[of] == label] *= 0.5 / care[y[of] == label].sum()
    care, target = (care * len(chunks)).astype(np.float32), y[of].astype(np.float32)
    parts = network.parts()
    mean, square, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    steps = epochs * -(-len(chunks) // BATCH)
    for _ in range(epochs):
        order = draw.permutation(len(chunks))
        for a in range(0, len(order), BATCH):
            own = order[a : a + BATCH]
            t += 1
            rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
            for p, m, s, g in zip(parts, mean, square, network.slopes(chunks[own], target[own], care[own] / len(own)), strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**t) / (np.sqrt(s / (1 - 0.999**t)) + 1e-7) + 1e-3 * p)
    x = features(network.logits(whole), counts)
    return Model(network, logistic(x, y, np.array(shares)[y], keep=1e-3))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 by 3. A null id is not held out and is not learned from either."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def sampled_chunks(docs: DataFrame, most: int) -> DataFrame:
    """doc_id, quality, chunks: at most `most` chunks of each text, end to end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chunks_of(raw or b"", most).tobytes() for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.binary())], ["doc_id", "quality", "chunks"])

    return map_batches(docs.select("doc_id", "quality", F.col("text").cast("binary").alias("raw")), cut, "doc_id long, quality int, chunks binary")


def fit(docs: DataFrame, labels: DataFrame, most_good: int = SAMPLE_GOOD, most_bad: int = SAMPLE_BAD, most_chunks: int = SAMPLE_CHUNKS) -> Model:
    """Learns from documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.least(F.min("quality"), F.lit(1)).alias("quality"))
    count = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    by = F.xxhash64("doc_id", F.lit("quality"))
    ids = known.where("quality = 1").orderBy(by, "doc_id").limit(most_good).unionByName(known.where("quality = 0").orderBy(by, "doc_id").limit(most_bad))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    rows = sampled_chunks(rows, most_chunks).orderBy(by, "doc_id", "chunks").limit(most_good + most_bad).collect()
    got = Counter(r["quality"] for r in rows)
    texts = [np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in rows]
    return train(texts, [r["quality"] for r in rows], tuple(count.get(k, 0) / max(1, got[k]) for k in (0, 1)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for every row."""
    shared = shared_value(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = value_of(shared)
        for batch in batches:
            if batch.num_rows:
                p = model.scores([raw or b"" for raw in batch.column("raw").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw"))
    return map_batches(rows, run, "doc_id long, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
