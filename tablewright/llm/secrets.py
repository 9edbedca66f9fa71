"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least SHORTEST letters, digits and the marks that keys are written with, unless it is a plain word; or a value of
any characters behind a key word and `=` or `:`; or the password of an address (`user:value@host`). The forest looks at its length, the
transitions between kinds of characters, how evenly characters are spread, how much of it dictionary words cover, how much it looks like a path or
an address, and at the words next to it, which count by how often they stand before secrets among the findings.

It is trained in numpy on labelled findings (text before, candidate, text after, is_secret): those of findings.tsv, which states the source of each,
or any others that are given. Fold 0 (crc32 of the document that a finding stands in, or of the candidate where none is known, modulo 5) is kept from training, so no document stands on both
sides, and `held_out_quality` gives precision and recall on it.
The dictionary is counted over all documents; at most DICTIONARY words, those that most documents hold, are kept.

`scan` finds the spans, `redact` replaces them. Spans are in characters, from 0, end excluded.

Null and empty texts have no candidate, an empty table gives no row and an empty dictionary. Very long texts and candidates are read whole. Repeated rows
are scanned each; a null id is scanned like any other. Where candidates overlap, the value behind a key word counts (ties: the earlier, then the longer). The
caller's own columns named n_candidates or secrets are replaced, all others stay.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, map_batches, shared_value, table, value_of

SHORTEST = 16
RUN = re.compile(r"(?<![A-Za-z0-9+/_.\-])[A-Za-z0-9+/_.\-]{16,}={0,2}")
#: Values behind `=` or `:` (group 1, 2 or 3), the key words that must stand before it, and passwords in addresses.
ASSIGNED = re.compile(r"(?:=>|:=|[:=])\s*(?:\"([^\"\n]{6,})\"|'([^'\n]{6,})'|([^\s\"',;]{6,}))")
KEYED = re.compile(r"(?:password|passwd|passphrase|pwd|secret|token|credentials?|auth|key)[\"']?\s*$", re.I)
ADDRESS = re.compile(r"://[^\s/:@]+:([^\s/@]{3,})@")
#: Characters of context on either side.
CONTEXT = 32
#: Words of the dictionary, and documents that must hold one at least.
DICTIONARY, LEAST_DOCUMENTS = 20_000, 2
TREES, DEPTH, LEAF = 40, 9, 3
MARK = "<SECRET>"
FINDINGS = Path(__file__).with_name("findings.tsv")
#: Text before, candidate, text after, whether it is a secret and, where known, the document.
Finding = tuple[str, str, str, bool] | tuple[str, str, str, bool, str]


def kinds(s: str) -> np.ndarray:
    return np.array([0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in s])


def covered(s: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words of four letters or more cover."""
    low, n = s.lower(), len(s)
    mask, at = np.zeros(n, bool), 0
    while at < n:
        size = next((k for k in range(min(12, n - at), 3, -1) if low[at : at + k] in words), 0)
        mask[at : at + size] = True
        at += max(1, size)
    return float(mask.mean()) if n else 0.0


def neighbours(left: str) -> list[str]:
    """The last three words before a candidate, cut at case changes and underscores."""
    return [w.lower() for w in re.findall(r"[^\W\d_]+", left)][-3:]


def features(left: str, s: str, right: str, words: frozenset[str], odds: dict[str, float]) -> list[float]:
    k = kinds(s)
    share = np.array(list(Counter(s).values())) / len(s)
    near = [odds.get(w, 0.0) for w in neighbours(left)] or [0.0]
    runs = np.diff(np.flatnonzero(np.r_[True, k[1:] != k[:-1], True]))
    return [
        len(s),
        float((k[1:] != k[:-1]).mean()) if len(s) > 1 else 0.0,
        float(-(share * np.log2(share)).sum()),
        float((k == 2).mean()),
        float((k == 1).mean()),
        float((k == 0).mean()),
        float(runs.max() / len(s)),
        covered(s, words),
        float(s.count("/") + s.count("\\")),
        float(s.count(".")),
        float(s.count("-") + s.count("_")),
        float("@" in left[-1:] or "@" in right[:1] or "://" in left[-8:] or left[-1:] == "/"),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+=*", s))),
        max(near),
        min(near),
        float(left.rstrip(" \"'`")[-1:] in ("=", ":")),
        float(left[-1:] in "\"'`" and left[-1:] != ""),
        float(s[:1] in "<[{$*%" or " " in s),
    ]


@dataclass
class Tree:
    """Node i tests feature[i] <= at[i]; a leaf has feature -1 and holds the share of secrets."""

    feature: list[int] = field(default_factory=list)
    at: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)

    def grow(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = 0) -> int:
        me = len(self.feature)
        for values, v in zip((self.feature, self.at, self.low, self.high), (-1, float(y.mean()), 0, 0), strict=True):
            values.append(v)
        if depth >= DEPTH or len(y) < 2 * LEAF or y.min() == y.max():
            return me
        best = (1e-9, -1, 0.0)
        whole = y.mean() * (1 - y.mean())
        for f in rng.choice(x.shape[1], int(np.ceil(x.shape[1] ** 0.5)), replace=False):
            for t in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 12))):
                side = x[:, f] <= t
                n = int(side.sum())
                if LEAF <= n <= len(y) - LEAF:
                    a, b = y[side].mean(), y[~side].mean()
                    gain = whole - (n * a * (1 - a) + (len(y) - n) * b * (1 - b)) / len(y)
                    if gain > best[0]:
                        best = (gain, int(f), float(t))
        if best[1] >= 0:
            side = x[:, best[1]] <= best[2]
            self.feature[me], self.at[me] = best[1], best[2]
            self.low[me] = self.grow(x[side], y[side], rng, depth + 1)
            self.high[me] = self.grow(x[~side], y[~side], rng, depth + 1)
        return me

    def __call__(self, row: list[float]) -> float:
        i = 0
        while self.feature[i] >= 0:
            i = self.low[i] if row[self.feature[i]] <= self.at[i] else self.high[i]
        return self.at[i]


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates, in order and apart."""
    keyed = (m for m in ASSIGNED.finditer(text) if KEYED.search(text[max(0, m.start() - CONTEXT) : m.start()]))
    spans = [next((m.span(g), 0) for g in (1, 2, 3) if m.group(g) is not None) for m in keyed] + [(m.span(1), 0) for m in ADDRESS.finditer(text)]
    for m in RUN.finditer(text):
        a, b = m.span()
        s = m.group().rstrip(".-")
        if len(s) >= SHORTEST and not (s.isalpha() and (s.islower() or s.isupper() or s.istitle())):
            spans.append(((a, a + len(s)), 1))
    spans.sort(key=lambda x: (x[1], x[0][0], -x[0][1]))
    if len(spans) < 2:
        return [s for s, _ in spans]
    taken = np.zeros(len(text), bool)
    out = []
    for (a, b), _ in spans:
        if not taken[a:b].any():
            taken[a:b] = True
            out.append((a, b))
    return sorted(out)


@dataclass
class Model:
    trees: list[Tree]
    words: frozenset[str]
    odds: dict[str, float]

    def probability(self, left: str, s: str, right: str) -> float:
        row = features(left, s, right, self.words, self.odds)
        return float(np.mean([t(row) for t in self.trees])) if self.trees else 0.0

    def spans(self, text: str | None, threshold: float = 0.5) -> tuple[int, list[tuple[int, int, float]]]:
        """(candidates, (start, end, probability) of the secrets)."""
        found, every = [], candidates(text or "")
        for a, b in every:
            p = self.probability(text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT])
            if p >= threshold:
                found.append((a, b, p))
        return len(every), found


def read_findings(path: Path = FINDINGS) -> list[Finding]:
    rows = [line.rstrip("\n").split("\t") for line in path.open(encoding="utf-8") if not line.startswith("#")]
    return [(left, s, right, label == "1", source if source.startswith("documents:") else s) for source, left, s, right, label in rows]


def learned_from(finding: Finding) -> bool:
    return zlib.crc32((finding[4] if len(finding) > 4 else finding[1]).encode("utf-8", "surrogatepass")) % 5 != 0


def train(findings: list[Finding], words: frozenset[str], seed: int = 11) -> Model:
    """Trees on bootstrap samples of the findings that are not held out."""
    findings = [f for f in findings if learned_from(f)]
    if not findings:
        return Model([], words, {})
    seen = [Counter(w for left, _, _, y, *_ in findings if y == label for w in set(neighbours(left))) for label in (False, True)]
    total = [sum(1 for f in findings if f[3] == label) for label in (False, True)]
    # Words that two findings or more have beside them.
    odds = {w: float(np.log((seen[1][w] + 0.5) / (total[1] + 1)) - np.log((seen[0][w] + 0.5) / (total[0] + 1))) for w in seen[0] | seen[1] if seen[0][w] + seen[1][w] > 1}
    x = np.array([features(a, s, b, words, odds) for a, s, b, *_ in findings])
    y = np.array([float(f[3]) for f in findings])
    rng, trees = np.random.default_rng(seed), []
    for _ in range(TREES):
        rows = rng.integers(0, len(y), len(y))
        tree = Tree()
        tree.grow(x[rows], y[rows], rng)
        trees.append(tree)
    return Model(trees, words, odds)


def held_out_quality(model: Model, findings: list[Finding], threshold: float = 0.5) -> tuple[float, float]:
    """Precision and recall on the findings that training does not see."""
    rows = [(model.probability(*f[:3]) >= threshold, f[3]) for f in findings if not learned_from(f)]
    hits = sum(p and y for p, y in rows)
    return hits / max(1, sum(p for p, _ in rows)), hits / max(1, sum(y for _, y in rows))


def dictionary(docs: DataFrame, most: int = DICTIONARY) -> frozenset[str]:
    """The words of 4 to 12 letters that most documents hold, counted over all documents: those above the lowest eighth of an octave at
    which no more than `most` qualify. Only the histogram of the eighths and those words come to the driver."""
    words = F.filter(F.array_distinct(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+")), lambda w: F.length(w).between(4, 12))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").count().where(F.col("count") >= LEAST_DOCUMENTS)
    counts = checkpointed(counts.select("word", F.floor(F.log2("count") * 8).cast("int").alias("eighth")))
    qualified, lowest = 0, None
    for eighth, n in sorted(((r["eighth"], r["count"]) for r in counts.groupBy("eighth").count().collect()), reverse=True):
        qualified += n
        if qualified > most:
            break
        lowest = eighth
    return frozenset(r["word"] for r in counts.where(F.col("eighth") >= lowest).collect()) if lowest is not None else frozenset()


def fit(docs: DataFrame, findings: list[Finding] | None = None) -> Model:
    return train(read_findings() if findings is None else findings, dictionary(docs))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of `docs` plus n_candidates and secrets, an array of (start, end, probability)."""
    shared = shared_value(docs.sparkSession, model)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_candidates", "secrets")])
    schema = docs.withColumns({"n_candidates": F.lit(0), "secrets": F.array().cast("array<struct<start:int,end:int,probability:double>>")}).schema
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = value_of(shared)
        struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])
        for batch in batches:
            found = [model.spans(t) for t in batch.column(at).to_pylist()]
            secrets = pa.array([[dict(start=a, end=b, probability=p) for a, b, p in s] for _, s in found], pa.list_(struct))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([n for n, _ in found], pa.int32()), secrets], [*batch.schema.names, "n_candidates", "secrets"])

    return map_batches(docs, run, schema)


def redact(scanned: DataFrame, mark: str = MARK) -> DataFrame:
    """Replaces each secret in `text` by `mark`, from the last to the first."""
    text = F.aggregate(F.reverse("secrets"), F.col("text"), lambda t, s: F.when(t.isNotNull(), F.concat(F.substring(t, F.lit(1), s["start"]), F.lit(mark), F.substring(t, s["end"] + 1, F.lit(1 << 30)))))
    return scanned.withColumn("text", F.when(F.size("secrets") > 0, text).otherwise(F.col("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scan(docs, fit(docs)).select("doc_id", "n_candidates", F.size("secrets").alias("n_secrets"), "secrets")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; secrets in its text are replaced and n_chars follows."""
    names = docs.columns
    out = redact(scan(docs, fit(docs)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.size("secrets") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*names)
