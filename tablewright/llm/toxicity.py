"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

Two words are similar if they share subsequences of three letters; a subsequence counts LAMBDA to the power of
the stretch it spans, at most SPAN letters, so `i.d.i.o.t` and `idiiot` stay close to `idiot`. Every word has
marks at both ends, and is scaled by its length. Because spans are bounded, a word's subsequences can be listed,
hashed and weighted; the kernel of two words is the product of their lists.

Landmarks are words of the labelled sample. The kernel against them, multiplied by the inverse root of their own
kernel matrix, is the Nyström map, in which a linear machine with squared hinge loss is trained. Its rows are labelled
sentences: each sentence inherits its document's label and stands for the word in it that tells most. Not every sentence of a
toxic document is toxic, so in each round its witnesses are the sentence that tells most and those whose word has clear odds; all
sentences of clean documents count as clean, the hardest before all, also where their word is one that toxic documents hold. Sentences that stand for the same word are one row,
which weighs as their number among toxic ones and as the root of it among clean ones. What tells most is read from the odds of words in the first round and
from the machine of the round before in the others. Landmarks, map and machine multiply to one weight for each hashed
subsequence, so a word's score is a sum of weights, and a sentence's score that of its best word. Letters
written apart (`i d i o t`) are read as a word.

A document is described by its highest sentence score and the number of its words that score above zero; a logistic fit
on them, weighted to the shares of the labels in the table, gives the probability.

Null and empty texts have no word; they get the score of a text whose words all score lowest. Null labels, null ids
and fold 0 are never learned from; of repeated labels of one id the toxic one counts. With one class only, all
scores are that of a constant. Repeated rows are scored each; an empty table gives no row. Texts and words of any length are
read whole. Ties between words go to the first in order. No other column of the caller is read or returned.
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

FEATURES = 1 << 16
LAMBDA, SPAN = 0.6, 5
#: Offsets of the second and third letter.
GAPS = [(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)]
#: Landmarks, and sentences of clean documents that are trained on (the hardest among them are chosen each round).
LANDMARKS, CLEAN_SENTENCES, HARD_SENTENCES = 240, 8_000, 2_000
#: The sample: so many toxic and so many other labelled documents at most.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1200, 2400
REMEMBERED = 600_000
ROUNDS = 3
#: Sentences end at these marks before white space, and at line ends.
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
APART = re.compile(r"(?<!\S)(?:[^\W\d_]\s){2,}[^\W\d_](?!\S)")
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
FLOOR = -2.0


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    words = text.split()
    words += ["".join(m.split()) for m in APART.findall(text)]
    return words


def sentences_of(text: str | None) -> list[list[str]]:
    """The distinct words of each sentence, sorted."""
    return [sorted(set(words)) for part in SENTENCE_END.split(text or "") if (words := words_of(part))]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, weight, word) of all subsequences of all words, words in ascending order."""
    marked = ["^" + w.strip(EDGES) + "$" for w in words]
    sizes = np.array([len(m) for m in marked])
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(letters))  # letters from here to the word's end
    found = []
    for j, k in GAPS:
        i = np.flatnonzero(left > k)
        code = letters[i] * np.uint32(2654435761) ^ letters[i + j] * np.uint32(2246822519) ^ letters[i + k] * np.uint32(3266489917)
        code ^= code >> np.uint32(15)
        code *= np.uint32(668265263)
        found.append(((code >> np.uint32(8)) % np.uint32(FEATURES), np.full(len(i), LAMBDA ** (k + 1)), word[i]))
    feature, weight, word = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(word, kind="stable")
    # The scale of a word: the length of its list if no subsequence came twice.
    n = np.maximum(1, np.bincount(word, weights=weight**2, minlength=len(words)))
    return feature[order].astype(np.int64), (weight / np.sqrt(n[word]))[order].astype(np.float32), word[order]


def against(words: list[str], table_: np.ndarray) -> np.ndarray:
    """words x columns: the sum of table_'s rows over the subsequences of each word."""
    out = np.zeros((len(words), table_.shape[1]))
    step = 4096 if table_.shape[1] == 1 else 256
    for at in range(0, len(words), step):
        feature, weight, word = subsequences(words[at : at + step])
        if len(word):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            out[at + word[first]] = np.add.reduceat(table_[feature] * weight[:, None], first, axis=0)
    return out


@dataclass
class Model:
    weights: np.ndarray  # of each hashed subsequence
    bias: float
    fit: np.ndarray  # logistic: constant, highest score, log of 1 + words above zero

    def probability(self, top: np.ndarray, above: np.ndarray) -> np.ndarray:
        z = self.fit[0] + self.fit[1] * np.maximum(top, FLOOR) + self.fit[2] * np.log1p(above)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def support_vectors(x: np.ndarray, y: np.ndarray, care: np.ndarray, rounds: int = 400, keep: float = 1e-5) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated gradient descent."""
    x = np.column_stack([x, np.ones(len(x))])
    care = care / care.sum()
    w = ahead = np.zeros(x.shape[1])
    step = 1 / (2 * np.linalg.eigvalsh((x * care[:, None]).T @ x)[-1] + keep)
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (-2 * x.T @ (care * y * slack) + keep * ahead)
        w, ahead = new, new + t / (t + 3) * (new - w)
    return w


def logistic(x: np.ndarray, y: np.ndarray, care: np.ndarray, keep: float = 1e-4) -> np.ndarray:
    """Newton's method for a logistic fit; x has a constant column first."""
    care, w = care / care.sum(), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (care * p * (1 - p))[:, None]).T @ x + keep * np.eye(x.shape[1])
        w += np.linalg.solve(h, x.T @ (care * (y - p)) - keep * w)
    return w


def train(texts: list[str], toxic: list[int], shares: tuple[float, float] = (1.0, 1.0)) -> Model:
    """shares: documents of the table for each sampled one, of label 0 and of label 1."""
    y = np.array(toxic, int)
    care = np.array(shares)[y] if len(y) else np.zeros(0)
    if len(set(toxic)) < 2:
        z = -30.0 if not toxic or toxic[0] == 0 else 30.0
        return Model(np.zeros(FEATURES), 0.0, np.array([z, 0.0, 0.0]))
    numbers = Numbering()
    sentences: list[np.ndarray] = []  # the numbers of each sentence's words
    owner = []
    for k, text in enumerate(texts):
        own = sentences_of(text)
        sentences += [np.array(numbers.of(words), int) for words in own]
        owner += [k] * len(own)
    names, owner = list(numbers), np.array(owner, int)
    if not names:
        return Model(np.zeros(FEATURES), 0.0, logistic(np.column_stack([np.ones(len(y)), np.full(len(y), FLOOR), np.zeros(len(y))]), y, care))
    edge = np.r_[np.flatnonzero(np.diff(owner, prepend=-1)), len(owner)]
    docs: list[np.ndarray] = [np.zeros(0, int)] * len(texts)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        docs[owner[a]] = np.unique(np.concatenate(sentences[a:b]))
    # Documents of each label that hold a word, and how much oftener toxic ones do, with half a document added on either side.
    inside = [np.bincount(np.concatenate([d for d, k in zip(docs, toxic, strict=True) if k == label]), minlength=len(names)) for label in (0, 1)]
    total = [int((y == 0).sum()), int((y == 1).sum())]
    odds = np.log((inside[1] + 0.5) / (total[1] + 1)) - np.log((inside[0] + 0.5) / (total[0] + 1))
    chance = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in names])
    sure = (inside[1] >= 2) & (odds > 1.5)
    strong = np.flatnonzero(sure)
    strong = strong[np.lexsort((chance[strong], -odds[strong] * np.log1p(inside[1][strong])))]
    others = np.argsort(np.where(inside[0] > 0, chance, np.iinfo(np.int64).max), kind="stable")[: int((inside[0] > 0).sum())]
    first = strong[: LANDMARKS * 2 // 3]
    marks = [names[i] for i in np.r_[first, others[: LANDMARKS - len(first)]]]
    # The landmarks' lists as columns, and the inverse root of their kernel matrix.
    lists = np.zeros((FEATURES, len(marks)), np.float32)
    feature, weight, word = subsequences(marks)
    np.add.at(lists, (feature, word), weight)
    value, vector = np.linalg.eigh((lists.T @ lists).astype(np.float64))
    root = vector * (np.where(value > 1e-6 * value[-1], 1 / np.sqrt(np.maximum(value, 1e-12)), 0.0))
    columns = lists @ root.astype(np.float32)
    del lists
    bad_side = y[owner] == 1
    clean = np.flatnonzero(~bad_side)
    spread = clean[np.argsort([zlib.crc32(int(i).to_bytes(8, "little")) for i in clean], kind="stable")]
    telling, weights, bias = odds, np.zeros(FEATURES), 0.0
    for _ in range(ROUNDS):
        best = np.array([s[telling[s].argmax()] for s in sentences])
        says = telling[best]
        # Witnesses: the sentence that tells most of each toxic document, and its others whose word has clear odds.
        order = np.lexsort((-says, owner))
        witness = order[np.diff(owner[order], prepend=-1) != 0]
        witness = witness[bad_side[witness]]
        witness = np.union1d(witness, np.flatnonzero(bad_side & sure[best]))
        witness = witness[odds[best[witness]] > 0]
        if not len(witness) or not len(clean):
            break
        hard = clean[np.argsort(-says[clean], kind="stable")[:HARD_SENTENCES]]
        calm = spread[: CLEAN_SENTENCES - len(hard)]
        # A clean sentence stands for its best word, and for one more so that all its words are covered by and by.
        more = np.array([sentences[i][i % len(sentences[i])] for i in calm], int)
        positive, often = np.unique(best[witness], return_counts=True)
        negative, seen = np.unique(np.r_[best[hard], best[calm], more], return_counts=True)
        rows = np.concatenate([against([names[i] for i in part], columns) for part in (positive, negative)])
        label = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        w = support_vectors(rows, label, np.r_[often / often.sum(), 2 * np.sqrt(seen) / np.sqrt(seen).sum()])
        weights, bias = columns @ w[:-1], float(w[-1])
        telling = against(names, weights[:, None])[:, 0] + bias
    scores = against(names, weights[:, None])[:, 0] + bias
    top = np.array([scores[i].max() if len(i) else FLOOR for i in docs])
    above = np.array([(scores[i] > 0).sum() for i in docs])
    x = np.column_stack([np.ones(len(docs)), np.maximum(top, FLOOR), np.log1p(above)])
    return Model(weights, bias, logistic(x, y, care))


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = SAMPLE_TOXIC, most_clean: int = SAMPLE_CLEAN) -> Model:
    """Learns from the folds 1 to 4. Sampled by a hash of the id, at most so many documents of each label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isNotNull() & (fold_of(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    by = F.xxhash64("doc_id", F.lit("toxicity"))
    ids = known.where("toxic = 1").orderBy(by, "doc_id").limit(most_toxic).unionByName(known.where("toxic = 0").orderBy(by, "doc_id").limit(most_clean))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    rows = rows.orderBy(by, "doc_id", "text").limit(most_toxic + most_clean).collect()
    got = Counter(r["toxic"] for r in rows)
    return train([r["text"] or "" for r in rows], [r["toxic"] for r in rows], tuple(count.get(k, 0) / max(1, got[k]) for k in (0, 1)))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.numbers, self.scores = Numbering(), np.zeros(0)

    def __call__(self, texts: list[str | None]) -> list[float]:
        if len(self.numbers) > REMEMBERED:
            self.clear()
        parts = [np.array(self.numbers.of(words_of(t)), np.int64) for t in texts]
        if self.numbers.new:
            new = against(self.numbers.new, self.model.weights[:, None])[:, 0] + self.model.bias
            self.scores, self.numbers.new = np.concatenate([self.scores, new]), []
        own = [self.scores[i] for i in parts]
        top = np.array([s.max() if len(s) else FLOOR for s in own])
        # Distinct words, as in training: a word that comes often says no more.
        above = np.array([len(set(i[s > 0].tolist())) for i, s in zip(parts, own, strict=True)])
        return self.model.probability(top, above).tolist()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for every row."""
    shared = shared_value(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = value_of(shared)
        scorer = kept_by_worker(("toxicity", zlib.crc32(model.weights.tobytes())), lambda: Scorer(model))
        for batch in batches:
            p = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32())], ["doc_id", "score", "predicted"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
