"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A word is cut into its byte n-grams (with marks for its start and end) and itself; each is hashed to a row of
an embedding table. A text is the mean of the rows of all its subwords, and a linear layer with softmax gives
a probability for each language. Table and layer are trained by stochastic gradient descent in numpy on a
bounded sample of labelled texts, whole ones and short stretches of them, so that short texts score well too.

Once trained, table and layer multiply to one row of class weights for each bucket, so scoring a text is a
sum of rows. Words repeat, so a task remembers the sum of each word. Long runs of letters, as scripts without spaces have
them, are cut into pieces that know the bytes before them, so that together they have just the n-grams of the whole run.

Calibration: a part of the sample is kept from training. A temperature is fitted on it, and the rejection
threshold is the probability that all but a stated share of its texts exceed. `rejected` says that a text has
no language (null, or no letter) or scores below the threshold.

Null ids, null labels and empty texts are never learned from. With nothing to learn from, every text is `und`. Repeated rows are scored each; no
row is dropped, and an empty table gives none. Very long texts and words are read whole. Of equal probabilities the language that sorts first is
given. The caller's own columns named lang_pred, score or rejected are replaced, all others stay.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import Numbering, fold_of, held_out, kept_by_worker, map_batches, shared_value, table, value_of

UNKNOWN = "und"
BUCKETS, WIDTH = 1 << 16, 16
GRAMS = (1, 2, 3, 4)
#: The sample: so many labelled texts in expectation, shared evenly by the languages, but so many for each language at least.
SAMPLE_ROWS, LEAST_EACH = 2400, 12
#: Letters in one piece of a long run, and the mark of a side where the run goes on.
PIECE, GOES_ON = 40, "\0"
EPOCHS, RATE = 3, 0.5
#: Share of the calibration texts that may fall below the rejection threshold, and the highest threshold.
REJECTED_SHARE, HIGHEST_THRESHOLD = 0.001, 0.5
REMEMBERED = 600_000
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    words = LETTERS.findall(text.lower()) if text else []
    return words if max(map(len, words), default=0) <= PIECE else [p for w in words for p in pieces(w)]


def pieces(word: str) -> list[str]:
    """The word if it is short, or else its pieces, each between the letters before it and the mark that the word goes on."""
    if len(word) <= PIECE:
        return [word]
    before = lambda i: GOES_ON + word[i - max(GRAMS) + 1 : i] + GOES_ON if i else ""
    return [before(i) + word[i : i + PIECE] + (GOES_ON if i + PIECE < len(word) else "") for i in range(0, len(word), PIECE)]


def has_letter(text: str | None) -> bool:
    return bool(text) and (any(w.isalpha() for w in LETTERS.findall(text[:200])) or any(map(str.isalpha, text)))


def subwords(word: str) -> list[int]:
    """Buckets of the word or piece and of its byte n-grams, less those that the piece before it has."""
    before, known = b"<", 0
    if word[:1] == GOES_ON:
        _, letters, word = word.split(GOES_ON, 2)
        before = letters.encode("utf-8", "surrogatepass")[1 - max(GRAMS) :]
        known = len(before)
    own = word.rstrip(GOES_ON).encode("utf-8", "surrogatepass")
    raw = before + own + (b"" if word[-1:] == GOES_ON else b">")
    found = [zlib.crc32(raw[i : i + n], n) % BUCKETS for n in GRAMS for i in range(max(0, known - n + 1), len(raw) - n + 1)]
    found.append(zlib.crc32(b"<" + own + b">") % BUCKETS)
    return found


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """sums: texts x (class weights summed over subwords, number of subwords)."""
        logits = (sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias) / self.temperature
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their shares."""
    counts: Counter[int] = Counter()
    for word, n in Counter(words).items():
        for b in subwords(word):
            counts[b] += n
    at, n = np.array(list(counts), np.int32), np.array(list(counts.values()), np.float32)
    return at, n / n.sum()


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    learn, check = [], []
    for i, (text, label) in enumerate(zip(texts, labels, strict=True)):
        words, y = words_of(text), languages.index(label)
        if not words:
            continue
        # Words take many times the room of their features, so no more than one text's are held.
        into = check if i % 5 == 0 else learn
        into.append((*features(words), y))
        for _ in range(2):  # short stretches, from one word to 30
            size = int(rng.integers(1, 31))
            at = int(rng.integers(0, max(1, len(words) - size + 1)))
            into.append((*features(words[at : at + size]), y))
    n = len(languages)
    if not learn or n == 0:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    table_, layer, bias = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32), np.zeros((WIDTH, n), np.float32), np.zeros(n, np.float32)
    share = np.bincount([y for *_, y in learn], minlength=n) / len(learn)
    care = 1 / np.maximum(share * n, 0.05)  # rare languages count as much as common ones
    total, step = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(learn)):
            at, weight, y = learn[k]
            rate = RATE * (1 - step / total)
            step += 1
            mean = weight @ table_[at]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            p *= care[y]
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            table_[at] -= (rate * len(at) ** 0.5) * np.outer(weight, back)
    model = Model(languages, (table_ @ layer).astype(np.float32), bias)
    calibrate(model, check or learn)
    return model


def calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    sums = np.stack([np.append(w @ model.weights[at], 1) for at, w, _ in rows])
    y = np.array([y for *_, y in rows])
    loss = {}
    for t in np.geomspace(0.2, 5, 25):
        model.temperature = float(t)
        loss[float(t)] = -np.log(np.maximum(1e-9, model.probabilities(sums)[np.arange(len(y)), y])).mean()
    model.temperature = min(loss, key=loss.get)
    best = model.probabilities(sums).max(axis=1)
    model.threshold = float(min(HIGHEST_THRESHOLD, np.quantile(best, REJECTED_SHARE)))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from text and lang of the folds 1 to 4. The sample has about `sample_rows` whole texts: each
    language's rows are thinned by a hash of their id to an even share of it. Every language is learned."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of(F.col("doc_id")) != 0))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return train([], [])
    each = max(LEAST_EACH, sample_rows / len(counts))
    shares = spark.createDataFrame([(r["lang"], min(1.0, each / r["count"])) for r in counts], "lang string, share double")
    wide = 1 << 30
    by = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(wide))
    sample = rows.join(F.broadcast(shares), "lang").where(by < F.col("share") * wide).withColumn("by", by).orderBy("by", "doc_id").limit(2 * round(each * len(counts)))
    # As Arrow, so that the texts are not rows in the driver's JVM first.
    sample = sample.select("text", "lang").toArrow()
    return train(sample.column("text").to_pylist(), sample.column("lang").to_pylist())


class Scorer:
    """Sums of class weights for each word that was seen, by its number."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.numbers, self.sums = Numbering(), np.zeros((0, len(self.model.languages) + 1), np.float32)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.numbers) > REMEMBERED:
            self.clear()
        width = len(self.model.languages) + 1
        parts = [np.array(self.numbers.of(words_of(t)), np.int64) for t in texts]
        if self.numbers.new:
            grams = [subwords(w) for w in self.numbers.new]
            sizes = np.array([len(g) for g in grams])
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            flat = self.model.weights[np.fromiter((b for g in grams for b in g), np.int64, int(sizes.sum()))]
            new = np.concatenate([np.add.reduceat(flat, at, axis=0), sizes[:, None]], axis=1).astype(np.float32)
            self.sums, self.numbers.new = np.concatenate([self.sums, new]), []
        total = np.stack([self.sums[i].sum(axis=0, dtype=np.float64) if len(i) else np.zeros(width) for i in parts]) if parts else np.zeros((0, width))
        if width == 1:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        p = self.model.probabilities(total)
        best = p.argmax(axis=1)
        known = [has_letter(t) for t in texts]
        return [self.model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], [float(p[i, b]) if k else 0.0 for i, (b, k) in enumerate(zip(best, known, strict=True))]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of `docs` plus lang_pred, score, rejected. The model has a fixed size and is broadcast."""
    shared = shared_value(docs.sparkSession, model)
    names = docs.columns
    clash = {"lang_pred", "score", "rejected"} & {n.lower() for n in names}
    if clash:
        docs = docs.drop(*[n for n in names if n.lower() in clash])
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(False)}).schema
    at = [n.lower() for n in docs.columns].index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = value_of(shared)
        scorer = kept_by_worker(("language", zlib.crc32(model.weights.tobytes())), lambda: Scorer(model))
        for batch in batches:
            lang, p = scorer(batch.column(at).to_pylist())
            rejected = [a == UNKNOWN or b < model.threshold for a, b in zip(lang, p, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(p, pa.float64()), pa.array(rejected, pa.bool_())], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return map_batches(docs, score, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is not rejected."""
    return identify(docs, fit(docs)).where(~F.col("rejected")).select(*docs.columns)
