"""Token counts with a unigram vocabulary, by a Viterbi search that keeps only scores and counts.

A unigram tokenizer splits a text into the vocabulary pieces whose scores have the largest sum. To count
tokens nobody needs the pieces themselves: for each end position the best score and the number of pieces on
that path are enough. An Aho-Corasick automaton lists the pieces that end at each position, longest first,
and a later piece replaces an earlier one only if its score is strictly larger. That is the tie rule of the
public unigram tokenizers, which walk start positions from left to right and replace on "greater than" only.

A character without any piece of its own costs the smallest score of the vocabulary less 10 and counts as
one token for each of its UTF-8 bytes (byte fallback), or one token for each run of such characters.

Spaces become U+2581 and one is put before the text, as the public model files expect. Where no piece of the
vocabulary reaches over a border of a word, words can be solved one at a time and remembered.

Null and empty texts have 0 tokens. Repeated rows are counted each; no row is dropped, and an empty table gives none. Very long texts are counted
whole, word by word where the vocabulary allows it. Other columns of the caller are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import kept_by_worker, map_batches, table

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task remembers at most; then it forgets all and starts again.
REMEMBERED = 600_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece file and their scores, in the order of the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not any(f(i) for f in special)]


class Counter:
    """Counts the pieces of the best path. `pieces`: (piece, score) pairs."""

    def __init__(self, pieces: Iterable[tuple[str, float]], byte_fallback: bool = True) -> None:
        pieces = [(p, s) for p, s in dict(pieces).items() if p]
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.empty = not pieces
        inner = {c for p, _ in pieces if len(p) > 1 for c in p}
        # Words can be solved alone if U+2581 occurs only at the front of a piece.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        lone = "" if "\n" in inner else "\n"
        self.words = re.compile(f"{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+" + (f"|{lone}" if lone else ""))
        self.known: dict[str, int] = {}
        self.single = {p for p, _ in pieces if len(p) == 1}

    def path(self, text: str) -> int:
        """Tokens of one stretch of text, its spaces already U+2581."""
        size = len(text)
        best, count, lost = [-math.inf] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        best[0] = 0.0
        if self.single.issuperset(text):  # no character is unknown; pyahocorasick lists the longest piece of an end first
            for last, (length, score) in self.automaton.iter(text):
                if (total := best[last + 1 - length] + score) > best[last + 1]:
                    best[last + 1], count[last + 1] = total, count[last + 1 - length] + 1
            return count[size]
        ends: dict[int, list[tuple[int, float]]] = {}
        if not self.empty:
            for end, match in self.automaton.iter(text):
                ends.setdefault(end + 1, []).append(match)
        for end in range(1, size + 1):
            single = False
            for length, score in sorted(ends.get(end, ()), reverse=True):
                single |= length == 1
                if (total := best[end - length] + score) > best[end]:
                    best[end], count[end], lost[end] = total, count[end - length] + 1, False
            if not single and (total := best[end - 1] + self.unknown) > best[end]:
                best[end], lost[end] = total, True
                if self.byte_fallback:
                    count[end] = count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    count[end] = count[end - 1] + (not lost[end - 1])
        return count[size]

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_word or not self.byte_fallback:
            return self.path(text)
        known, total = self.known, 0
        for word in self.words.findall(text):
            n = known.get(word)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = self.path(word)
                if len(word) <= 64:
                    known[word] = n
            total += n
        return total


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], byte_fallback: bool = True) -> DataFrame:
    """doc_id, n_tokens: the size of each text's best path. The vocabulary has a fixed size and travels with the plan."""

    key = zlib.crc32(repr((pieces, byte_fallback)).encode())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_by_worker(("counter", key), lambda: Counter(pieces, byte_fallback))
        for batch in batches:
            n = [counter(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_chars"), pa.array(n, pa.int64())], ["doc_id", "n_chars", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.char_length("text").cast("long"), F.lit(0).cast("long")).alias("n_chars"))
    return map_batches(rows, count, "doc_id long, n_chars long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
