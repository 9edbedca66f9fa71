"""Suffix-array dedup by prefix-free parsing: bytes of 50-byte strings that an earlier document also has are removed.

The order of all suffixes of the corpus brings equal 50-byte strings together; in each run of neighbours that share their first 50 bytes, every
string of another than the smallest document goes. The order is worked out in parts that can be sorted apart from each other, and each part by
prefix-free parsing (`corpus_order`): a hash rolls over the text, its triggers cut phrases that overlap by the trigger, the
distinct phrases are the dictionary and their sequence is the parse. The suffix array of the dictionary orders suffixes within a
phrase, which are prefix-free, and the suffix array of the parse breaks the ties by what follows the phrase; both combine into the
order of the part. Where text repeats much, the dictionary is small and most of the order comes from the parse.

Parts: another rolling hash, over TRIGGER bytes, names every 50-byte string by the smallest hash in it. Equal strings have equal names, so
strings are dealt by name, as runs of neighbouring strings of one name (with their last 49 bytes shared with the next run). Equal texts
are cut equally.

Work is cut down before anything is sorted. Documents are dealt by a hash of their id to blocks of about BLOCK_BYTES, and blocks talk to
buckets of names in three rounds, each a compact list from block to bucket and an answer of bits back:

1. names: which of them occur in more than one document;
2. runs of those names: which have a smaller document elsewhere (all their strings go), and which share a name with other phrases;
3. the latter's bytes, once for each distinct run: its suffixes are put in order, and the strings with a smaller document are marked.

Matches never cross documents. A repeat within one document stays. Null text counts as empty. Rows with a null id lose nothing and take
nothing from others. Repeated rows of one id are handled each and take nothing from one another. Of a tie between documents the smallest
id keeps the string. A very long text is parsed whole, alone in its chunk; its block holds it in memory. Empty texts and an empty table
give rows of zeros and no row. Other columns of the caller are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import table

LENGTH, TRIGGER = 50, 24
#: Bytes of text in a block of documents, and bytes of text whose names meet in one bucket.
BLOCK_BYTES, BUCKET_BYTES = 4_000_000, 16_000_000
#: The parse within a bucket: bytes of a trigger, and one of so many places is one.
PHRASE_TRIGGER, PHRASE_EVERY = 6, 24
#: Bytes of text that are parsed at once within a block.
CHUNK_BYTES = 400_000
NAME_BITS = 44
_RNG = np.random.default_rng(20240315)
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(by)
    return h ^ (h >> np.uint64(32))


def power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def names_of(raw: np.ndarray, length: int, trigger: int) -> np.ndarray:
    """The name of the string of `length` bytes at each position: the smallest trigger hash in it."""
    spans = {1: BYTE[raw]}
    size = 1
    while size * 2 <= trigger:
        h = spans[size]
        spans[size * 2] = h[: len(h) - size] * power(size) + h[size:]
        size *= 2
    total, have = spans[size], size
    for part in sorted(spans, reverse=True):  # trigger as a sum of powers of two
        while have + part <= trigger:
            tail = spans[part][have:]
            total = total[: len(tail)] * power(part) + tail
            have += part
    low, width, want = mix(total, 0xBF58476D1CE4E5B9), 1, length - trigger + 1
    while width < want:
        step = min(width, want - width)
        low = np.minimum(low[: len(low) - step], low[step:])
        width += step
    return mix(low, 0x94D049BB133111EB) >> np.uint64(64 - NAME_BITS)


class Chunk(NamedTuple):
    """Some documents of a block, parsed: phrase i starts at start[i] of the joined bytes and has count[i] strings."""

    first: int  # index of the first document
    raw: bytes
    ends: np.ndarray  # of the documents
    start: np.ndarray
    count: np.ndarray
    name: np.ndarray
    row: np.ndarray  # index of the document


def parse(texts: list[bytes], length: int = LENGTH, trigger: int = TRIGGER) -> Iterator[Chunk]:
    at = 0
    while at < len(texts):
        last, size = at, 0
        while last < len(texts) and (last == at or size + len(texts[last]) <= CHUNK_BYTES):
            size += len(texts[last])
            last += 1
        raw = b"".join(texts[at:last])
        sizes = np.array([len(t) for t in texts[at:last]])
        ends = np.cumsum(sizes)
        row = np.repeat(np.arange(at, last), sizes)
        none = np.zeros(0, np.int64)
        start, count, name = none, none, np.zeros(0, np.uint64)
        if len(raw) >= length:
            name_at = names_of(np.frombuffer(raw, np.uint8), length, trigger)
            n = len(name_at)
            good = np.flatnonzero(np.arange(n) + length <= np.repeat(ends, sizes)[:n])
            if len(good):
                new = np.r_[True, (np.diff(good) != 1) | (name_at[good[1:]] != name_at[good[:-1]]) | (row[good[1:]] != row[good[:-1]])]
                edge = np.flatnonzero(new)
                start, count = good[edge], np.diff(np.r_[edge, len(good)])
                name = name_at[start]
        yield Chunk(at, raw, ends, start, count, name, row[start] if len(start) else none)
        at = last


def packed(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences, bytes of equal weight together, so that compression finds the zeros."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def buckets_of(names: np.ndarray, n: int) -> np.ndarray:
    return ((names >> np.uint64(NAME_BITS - 24)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)


def suffix_ranks(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Ranks (from 1, equal for equal ones) of the suffixes of all strings that stand one after the other in `symbols`; `left` counts the
    symbols from each place to its string's end. Prefix doubling: suffixes ranked by their first k symbols are ranked by 2k with the
    rank k places on. Only suffixes that still share their rank, and have not ended, are looked at again."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    # As many symbols as fit into one number are ranked at once.
    key, k, most, longest = symbols.astype(np.int64), 1, int(symbols.max()) + 1, int(left.max())
    while k < longest and most ** (k + 1) < 1 << 62:
        further = np.zeros(n, np.int64)
        far = np.flatnonzero(left > k)
        further[far] = symbols[far + k]
        key = key * most + further
        k += 1
    rank = np.empty(n, np.int64)
    order = np.argsort(key)
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    sizes = np.diff(np.r_[first, n])
    rank[order] = np.repeat(first, sizes) + 1
    open_ = order[np.repeat(sizes > 1, sizes)]
    open_ = open_[left[open_] >= k]
    while len(open_):
        ended = left[open_] == k
        on = np.where(ended, 0, rank[np.where(ended, open_, open_ + k)])
        old = rank[open_]
        by = np.argsort(old * (n + 1) + on)
        at, old, on = open_[by], old[by], on[by]
        new_old = np.r_[True, old[1:] != old[:-1]]
        new = np.flatnonzero(new_old | np.r_[True, on[1:] != on[:-1]])
        # Members of the rank that have ended before stand in front, all alike, and are none of those looked at.
        base = np.maximum.accumulate(np.where(new_old, np.arange(len(at)), 0))
        sizes = np.diff(np.r_[new, len(at)])
        rank[at] = old + np.repeat(new, sizes) - base
        k *= 2
        open_ = at[np.repeat(sizes > 1, sizes)]
        open_ = open_[left[open_] >= k]
    return rank


def corpus_order(raw: np.ndarray, ends: np.ndarray, width: int = PHRASE_TRIGGER, every: int = PHRASE_EVERY) -> np.ndarray:
    """All places of the texts that stand one after the other in `raw` (the end of each in `ends`), in the order of their suffixes."""
    sizes = np.diff(np.r_[0, ends])
    text = np.repeat(np.arange(len(ends)), sizes)
    n = len(raw)
    # Triggers: places where the hash of `width` bytes of one text is zero modulo `every`. A phrase runs from a trigger (or the
    # text's start) to the end of the next trigger (or of the text).
    h = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        h = h * np.uint64(BASE) + BYTE[raw[j : n - width + 1 + j]]
    hit = np.flatnonzero(mix(h, 0xBF58476D1CE4E5B9) % np.uint64(every) == 0)
    hit = hit[(hit + width <= ends[text[hit]])] if len(hit) else hit
    start = np.union1d(hit, (ends - sizes)[sizes > 0]).astype(np.int64)
    follows = np.r_[start[1:], n]
    last = np.r_[text[start[1:]] != text[start[:-1]], True] if len(start) else np.zeros(0, bool)
    stop = np.where(last, ends[text[start]], follows + width) if len(start) else start
    # The dictionary, and the parse as numbers of its phrases.
    data = raw.tobytes()
    known: dict[tuple[bytes, bool], int] = {}
    parse_ = np.fromiter((known.setdefault((data[a:b], z), len(known)) for a, b, z in zip(start.tolist(), stop.tolist(), last.tolist(), strict=True)), np.int64, len(start))
    # A text's last phrase has an end mark that sorts before all bytes, so that no phrase suffix is a prefix of another.
    size = np.fromiter((len(p) + z for p, z in known), np.int64, len(known))
    symbols = np.frombuffer(b"".join(p + b"\0" * z for p, z in known), np.uint8).astype(np.int64) + 2
    begin = np.cumsum(size) - size
    symbols[(begin + size - 1)[np.fromiter((z for _, z in known), bool, len(known))]] = 1
    left = np.repeat(begin + size, size) - np.arange(len(symbols))
    in_phrase = suffix_ranks(symbols, left)
    # The suffix array of the parse: phrases by their rank (as numbers without gaps), texts apart.
    _, numbers = np.unique(in_phrase[begin], return_inverse=True)
    after = suffix_ranks(numbers[parse_] + 1, np.repeat(np.flatnonzero(last) + 1, np.diff(np.r_[0, np.flatnonzero(last) + 1])) - np.arange(len(parse_)))
    # Each place belongs to the phrase in which more than a trigger follows it.
    phrase = np.repeat(np.arange(len(start)), follows - start)
    place = np.arange(n) - start[phrase]
    tail = np.where(last, 0, np.r_[after[1:], 0])
    return np.lexsort((tail[phrase], in_phrase[begin[parse_[phrase]] + place]))


class Parser:
    """What one block knows: its texts, its names and its phrases. All lists are made anew in each round, in the same order."""

    def __init__(self, table_: pa.Table, n_buckets: int, length: int, trigger: int) -> None:
        rows = sorted(zip(table_.column("doc_id").to_pylist(), table_.column("raw").to_pylist(), strict=True), key=lambda r: (r[0], r[1]))
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.texts = [r[1] for r in rows]
        self.n_buckets, self.length = n_buckets, length
        self.chunks = list(parse(self.texts, length, trigger))
        self.block = table_.column("block")[0].as_py() if len(rows) else None

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names, ascending, and whether more than one document of the block has them."""
        name = np.concatenate([c.name for c in self.chunks])
        doc = np.concatenate([self.ids[c.row] for c in self.chunks])
        order = np.lexsort((doc, name))
        name, doc = name[order], doc[order]
        edge = runs(name)
        if not len(edge):
            return name, np.zeros(0, bool)
        return name[edge], np.maximum.reduceat(doc, edge) > np.minimum.reduceat(doc, edge)

    def entries(self, shared: np.ndarray) -> None:
        """Phrases of the shared names (ascending), each distinct one once, with its smallest document in the block."""
        self.uses = []  # for each chunk: indices of its phrases of shared names, and later their entries
        name, digest, doc = [], [], []
        for c in self.chunks:
            at = np.searchsorted(shared, c.name) if len(shared) else np.zeros(len(c.name), np.int64)
            use = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == c.name) if len(shared) else np.zeros(0, np.int64)
            bounds = zip(c.start[use].tolist(), (c.start[use] + c.count[use] + self.length - 1).tolist(), strict=True)
            self.uses.append(use)
            name.append(c.name[use])
            doc.append(self.ids[c.row[use]])
            digest.append(np.fromiter((xxhash.xxh3_64_intdigest(c.raw[a:b]) for a, b in bounds), np.uint64, len(use)))
        name, digest, doc = (np.concatenate(x) for x in (name, digest, doc))
        order = np.lexsort((doc, digest, name))
        new = np.r_[True, (name[order][1:] != name[order][:-1]) | (digest[order][1:] != digest[order][:-1])] if len(order) else np.zeros(0, bool)
        entry = np.zeros(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        head = order[new]
        self.name, self.digest, self.owner, self.sample = name[head], digest[head], doc[head], head
        self.entry = np.split(entry, np.cumsum([len(u) for u in self.uses])[:-1])

    def dealt(self, names: np.ndarray) -> Iterator[tuple[int, slice]]:
        """(bucket, slice) of ascending names."""
        bucket = buckets_of(names, self.n_buckets)
        edge = np.r_[runs(bucket), len(bucket)]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            yield int(bucket[a]), slice(a, b)


MAIL = "bucket int, block int, kind int, blob binary"


def mail(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["bucket", "block", "kind", "blob"])


def answers(table_: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(*(table_.column(c).to_pylist() for c in ("bucket", "kind", "blob")), strict=True)
    return {b: blob for b, k, blob in rows if k == kind}


class Rounds:
    """The functions that blocks and buckets run, for one length of strings."""

    def __init__(self, n_buckets: int, length: int, trigger: int) -> None:
        self.args = (n_buckets, length, trigger)
        self.length = length

    def send_names(self, docs: pa.Table) -> pa.Table:
        p = Parser(docs, *self.args)
        names, several = p.names()
        return mail([(b, p.block, 1, packed(names[s]) + np.packbits(several[s]).tobytes()) for b, s in p.dealt(names)])

    def share_names(self, letters: pa.Table) -> pa.Table:
        parts, several = [], []
        for blob in letters.column("blob").to_pylist():
            # n numbers of 8 bytes and n bits: n is the largest with 8 n + ceil(n / 8) bytes.
            n = len(blob) * 8 // 65
            parts.append(unpacked(blob[: 8 * n]))
            several.append(np.unpackbits(np.frombuffer(blob[8 * n :], np.uint8), count=n).astype(bool))
        names, flags = np.concatenate(parts), np.concatenate(several)
        _, index, count = np.unique(names, return_inverse=True, return_counts=True)
        shared = (count > 1) | (np.bincount(index, weights=flags, minlength=len(count)) > 0)
        out = np.split(shared[index], np.cumsum([len(x) for x in parts])[:-1])
        bucket = letters.column("bucket")[0].as_py()
        return mail([(bucket, block, 1, np.packbits(x).tobytes()) for block, x in zip(letters.column("block").to_pylist(), out, strict=True)])

    def send_phrases(self, docs: pa.Table, letters: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return mail([])
        p = Parser(docs, *self.args)
        names, _ = p.names()
        bits = answers(letters, 1)
        shared = [names[s][np.unpackbits(np.frombuffer(bits[b], np.uint8), count=s.stop - s.start).astype(bool)] for b, s in p.dealt(names)]
        p.entries(np.concatenate(shared) if shared else names)
        return mail([(b, p.block, 2, packed(p.name[s]) + p.digest[s].tobytes() + p.owner[s].tobytes()) for b, s in p.dealt(p.name)])

    def share_phrases(self, letters: pa.Table) -> pa.Table:
        parts = []
        for blob in letters.column("blob").to_pylist():
            n = len(blob) // 24
            parts.append((unpacked(blob[: 8 * n]), np.frombuffer(blob[8 * n : 16 * n], np.uint64), np.frombuffer(blob[16 * n :], np.int64)))
        name, digest, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((owner, digest, name))
        a, d, o = name[order], digest[order], owner[order]
        phrase = runs_of_pairs(a, d)
        least = np.repeat(o[phrase], np.diff(np.r_[phrase, len(o)]))
        named = runs(a)
        several = np.repeat(np.add.reduceat(np.isin(np.arange(len(a)), phrase).astype(np.int64), named) > 1, np.diff(np.r_[named, len(a)]))
        flags = np.zeros(len(a), np.uint8)
        flags[order] = (least < o) + 2 * several
        out = np.split(flags, np.cumsum([len(x[0]) for x in parts])[:-1])
        bucket = letters.column("bucket")[0].as_py()
        return mail([(bucket, block, 2, packed(x[0]) + f.tobytes()) for block, x, f in zip(letters.column("block").to_pylist(), parts, out, strict=True)])

    def read_phrases(self, docs: pa.Table, letters: pa.Table) -> tuple[Parser, np.ndarray]:
        """The block with its entries, and their flags."""
        p = Parser(docs, *self.args)
        names, flags = [], []
        for _, blob in sorted(answers(letters, 2).items()):
            n = len(blob) // 9
            names.append(unpacked(blob[: 8 * n]))
            flags.append(np.frombuffer(blob[8 * n :], np.uint8))
        p.entries(np.unique(np.concatenate(names)) if names else np.zeros(0, np.uint64))
        return p, np.concatenate(flags) if flags else np.zeros(0, np.uint8)

    def asked(self, p: Parser, flags: np.ndarray) -> np.ndarray:
        """Entries whose strings have to be looked at one by one: other phrases share their name, and this block has their first document."""
        return np.flatnonzero(flags == 2)

    def send_bytes(self, docs: pa.Table, letters: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return mail([])
        p, flags = self.read_phrases(docs, letters)
        ask = self.asked(p, flags)
        at = np.cumsum([0, *(len(u) for u in p.uses)])
        text = []
        for use in p.sample[ask]:
            k = int(np.searchsorted(at, use, "right")) - 1
            c, i = p.chunks[k], p.uses[k][use - at[k]]
            text.append(c.raw[c.start[i] : c.start[i] + c.count[i] + self.length - 1])
        size = np.array([len(t) for t in text], np.int32)
        out = []
        for b, s in p.dealt(p.name[ask]):
            n = s.stop - s.start
            out.append((b, p.block, 3, np.int32(n).tobytes() + size[s].tobytes() + p.owner[ask][s].tobytes() + b"".join(text[s])))
        return mail(out)

    def share_bytes(self, letters: pa.Table) -> pa.Table:
        """Puts the suffixes of the bucket's runs in order and marks the strings that a smaller document has."""
        parts, sizes, owners, of_letter = [], [], [], []
        for blob in letters.column("blob").to_pylist():
            n = int(np.frombuffer(blob[:4], np.int32)[0])
            sizes.append(np.frombuffer(blob[4 : 4 + 4 * n], np.int32).astype(np.int64))
            owners.append(np.frombuffer(blob[4 + 4 * n : 4 + 12 * n], np.int64))
            parts.append(np.frombuffer(blob[4 + 12 * n :], np.uint8))
            of_letter.append(int((sizes[-1] - self.length + 1).sum()))
        raw, size = np.concatenate(parts), np.concatenate(sizes)
        ends = np.cumsum(size)
        own = np.repeat(np.concatenate(owners), size)
        whole = np.arange(len(raw)) + self.length <= np.repeat(ends, size)  # places where a string starts
        order = corpus_order(raw, ends)
        order = order[whole[order]]
        windows = np.lib.stride_tricks.sliding_window_view(raw, self.length) if len(order) else np.zeros((0, self.length), np.uint8)
        same = np.zeros(len(order), bool)
        for at in range(1, len(order), 100_000):
            here = order[at : at + 100_000]
            same[at : at + 100_000] = (windows[here] == windows[order[at - 1 : at - 1 + len(here)]]).all(axis=1)
        edge = np.flatnonzero(~same)
        gone = np.zeros(len(raw), bool)
        if len(edge):
            least = np.repeat(np.minimum.reduceat(own[order], edge), np.diff(np.r_[edge, len(order)]))
            gone[order] = least < own[order]
        out = np.split(gone[whole], np.cumsum(of_letter)[:-1])
        bucket = letters.column("bucket")[0].as_py()
        return mail([(bucket, block, 3, np.packbits(x).tobytes()) for block, x in zip(letters.column("block").to_pylist(), out, strict=True)])

    def finish(self, docs: pa.Table, letters: pa.Table) -> pa.Table:
        n_rows = docs.num_rows
        out: list[list] = [[], [], [], [], []]
        if n_rows:
            p, flags = self.read_phrases(docs, letters)
            ask, bits = self.asked(p, flags), answers(letters, 3)
            # Strings of each asked entry, in the order in which its bytes were sent.
            counts = np.concatenate([c.count[u] for c, u in zip(p.chunks, p.uses, strict=True)])[p.sample[ask]] if len(ask) else np.zeros(0, np.int64)
            marks = [np.unpackbits(np.frombuffer(bits[b], np.uint8), count=int(counts[s].sum())).astype(bool) for b, s in p.dealt(p.name[ask])]
            mark = np.concatenate(marks) if marks else np.zeros(0, bool)
            first = np.zeros(len(flags), np.int64)
            first[ask] = np.cumsum(counts) - counts
            for c, use, entry in zip(p.chunks, p.uses, p.entry, strict=True):
                cover = np.zeros(len(c.raw) + 1, np.int64)
                doc = p.ids[c.row[use]]
                whole = (flags[entry] & 1 > 0) | (doc > p.owner[entry])
                np.add.at(cover, c.start[use][whole], 1)
                np.add.at(cover, c.start[use][whole] + c.count[use][whole] + self.length - 1, -1)
                part = np.flatnonzero(~whole & (flags[entry] == 2))
                if len(part):
                    n = c.count[use][part]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    hit = mark[np.repeat(first[entry[part]], n) + step]
                    where = (np.repeat(c.start[use][part], n) + step)[hit]
                    np.add.at(cover, where, 1)
                    np.add.at(cover, where + self.length, -1)
                gone = np.cumsum(cover)[:-1] > 0
                begin = 0
                raw = np.frombuffer(c.raw, np.uint8)
                for k, end in enumerate(c.ends.tolist()):
                    g = gone[begin:end]
                    kept = raw[begin:end][~g].tobytes()
                    spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if len(g) else 0
                    for values, v in zip(out, (int(p.ids[c.first + k]), end - begin, int(g.sum()), spans, hashlib.sha256(kept).hexdigest()), strict=True):
                        values.append(v)
                    begin = end
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def runs_of_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of `docs`."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw"))
    total = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n = max(12, -(-total // BLOCK_BYTES))
    blocks = rows.where("doc_id IS NOT NULL").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))
    r = Rounds(max(12, -(-total // BUCKET_BYTES)), length, trigger)
    by_block = lambda letters: blocks.groupBy("block").cogroup(letters.groupBy("block"))
    names = blocks.groupBy("block").applyInArrow(lambda t: r.send_names(t), MAIL).groupBy("bucket").applyInArrow(lambda t: r.share_names(t), MAIL)
    phrases = by_block(names).applyInArrow(lambda d, t: r.send_phrases(d, t), MAIL).groupBy("bucket").applyInArrow(lambda t: r.share_phrases(t), MAIL)
    marks = by_block(phrases).applyInArrow(lambda d, t: r.send_bytes(d, t), MAIL).groupBy("bucket").applyInArrow(lambda t: r.share_bytes(t), MAIL)
    out = by_block(phrases.unionByName(marks)).applyInArrow(lambda d, t: r.finish(d, t), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    apart = rows.where("doc_id IS NULL").select("doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2("raw", 256).alias("kept_sha256"))
    return out.unionByName(apart)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))
