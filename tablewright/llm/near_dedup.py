"""Near-duplicate groups by b-bit MinHash.

A text's set are its distinct shingles of five words (ASCII letters lower-cased); texts of fewer words are one shingle. Texts of
equal sets are one class, known by a 128-bit digest of the set, so exact copies cost one row each from there on.

Each class has HASHES minima. ROWS of them at a time make BANDS bucket keys: two sets of similarity 0.75 share none of the
32 keys with a probability of 5e-6. Only the low BITS of each minimum are kept, packed in longs; the agreeing
lanes of two signatures, counted by bit operations, give the similarity after the chance agreement of 1 in 2^BITS is taken
off. Pairs that the estimate puts five standard deviations below the threshold are dropped; every other pair
is confirmed on the full sets.

A bucket may hold a third of all documents, so its pairs are never listed. Each member of a bucket is first held against the few members
that speak for the bucket (HUBS of them), and each takes its STAR_CHECKS best estimates to the exact check. What is confirmed is
contracted. Then members of one bucket that are still in different components meet in blocks of bounded size: first by signature alone, which leaves
the members that have a likely partner, then these with their full sets, and only confirmed links leave. No pair of different components that
shares a bucket is left unseen. The blocks of a bucket grow with the square of the components that are left in it.

Components come from large-star and small-star steps on the links between classes, after each partition has contracted its own links; neither
links nor components pass through the driver. Copies never stand in a link: they take the component of their class.

Null and empty texts, and texts without a word, have no shingle and stand alone. Very long texts are read whole, one at a time. Repeated
rows of one id are one document with as many rows; if their texts differ, the id's links are those of all its texts. A row with a null id
stands alone: n_shingles is counted, component_id is null and it is kept. Ties (equal estimates) go to the smaller id. An empty table gives
no row. Other columns of the caller are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import checkpointed, join_hot, join_salted, map_batches, table

SHINGLE, PERCENT = 5, 75
BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
#: Members that speak for a bucket: the smallest, the largest, and the smallest after these bits are flipped.
FLIPS = (0x5A5A5A5A5A5A5A5A, 0x3C96A5F00F5A693C)
#: Pairs of a node that the star round confirms at most, and pairs whose ids may be broadcast.
STAR_CHECKS, BROADCAST_PAIRS = 4, 200_000
#: Links in a partition of the component steps.
LINKS_IN_PART = 200_000
#: Shingles in a block of a bucket that is compared by full sets, and members in one that is compared by signature.
BLOCK_SHINGLES, BLOCK_MEMBERS = 150_000, 1_500
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_RNG = np.random.default_rng(20240301)
FACTOR = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
OFFSET = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
#: Lanes that two sets of the threshold similarity agree on, less five standard deviations.
AGREE = PERCENT / 100 + (1 - PERCENT / 100) / 2**BITS
LEAST_LANES = int(HASHES * AGREE - 5 * (HASHES * AGREE * (1 - AGREE)) ** 0.5)
CHANCE = 2.0**-BITS
#: The similarity that so many lanes stand for; the small term keeps rounding harmless.
LEAST_ESTIMATE = (LEAST_LANES / HASHES - CHANCE) / (1 - CHANCE) - 1e-9


def shingles(raw: bytes | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's set. bytes.split() splits at exactly the bytes 0x20 and 0x09 to 0x0D."""
    words = raw.translate(LOWER).split() if raw else []
    if not words:
        return np.zeros(0, np.uint64)
    text = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.r_[0, end[:-1] + 1]
    k = min(SHINGLE, len(words))
    digest = xxhash.xxh3_64_intdigest
    found = {digest(text[a:b]) for a, b in zip(start[: len(words) - k + 1].tolist(), end[k - 1 :].tolist(), strict=True)}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def minima(s: np.ndarray) -> np.ndarray:
    x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        out = np.minimum(out, (x[at : at + 2048, None] * FACTOR + OFFSET).min(axis=0))
    return out


def sketch(s: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """(digest of the set, bucket keys, packed signature)."""
    m = minima(s)
    keys = [xxhash.xxh3_64_intdigest(m[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)]
    # The multiplier's low bits are weak, so lanes are cut from a hash of the minimum.
    low = ((m * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
    lanes = low.reshape(-1, 64 // BITS) << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))
    return xxhash.xxh3_128_digest(s.tobytes()), np.array(keys, np.uint64).view(np.int64).tolist(), np.bitwise_or.reduce(lanes, axis=1).view(np.int64).tolist()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest, bands, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, bands, signature = [], [], [], []
            for raw in batch.column("raw").to_pylist():
                s = shingles(raw)
                d, b, g = sketch(s) if len(s) else (None, None, None)
                for values, v in zip((n, digest, bands, signature), (len(s), d, b, g), strict=True):
                    values.append(v)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, longs), pa.array(signature, longs)], ["doc_id", "n_shingles", "digest", "bands", "signature"])

    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("raw")), run, "doc_id long, n_shingles long, digest binary, bands array<long>, signature array<long>")


def lanes_apart(a: str, b: str) -> Column:
    """Lanes in which two signatures differ."""
    total = F.lit(0)
    lane = sum(1 << k for k in range(0, 64, BITS))
    for k in range(HASHES * BITS // 64):
        x = F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(F.lit(lane)))
    return total


def similarity_estimate(apart: Column) -> Column:
    """The similarity that so many differing lanes stand for, corrected for chance agreement."""
    return F.greatest(F.lit(0.0), (1 - apart / F.lit(float(HASHES)) - CHANCE) / (1 - CHANCE))


def likely(estimate: Column, n_a: str, n_b: str) -> Column:
    """The sizes allow the similarity, and the estimate does not rule it out."""
    return (F.lit(100) * F.least(n_a, n_b) >= F.lit(PERCENT) * F.greatest(n_a, n_b)) & (estimate >= LEAST_ESTIMATE)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. `texts`: doc_id, raw."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("raw").alias("raw_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("raw").alias("raw_b"))
    # Many pairs may name one hub, so its text is dealt out with them.
    both = join_salted(pairs.select("a", "b").join(left, "a"), right, "b", checkpointed(pairs.groupBy("b").agg(F.count("*").alias("rows"))))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("raw_a").to_pylist(), batch.column("raw_b").to_pylist(), strict=True):
                if y != last[0]:  # pairs come ordered by b, often many of one
                    last = (y, shingles(y))
                s, t = shingles(x), last[1]
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(s) + len(t) - common) and common > 0)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return map_batches(both, check, "a long, b long").distinct()


def contracted(links: DataFrame) -> DataFrame:
    """Links (u, v) with the same components: within each partition, every node is linked to the smallest one that its links reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(u), root(v)
                parent[max(x, y)] = min(x, y)
        ends = [(x, root(x)) for x in parent]
        u, v = [x for x, y in ends if x != y], [y for x, y in ends if x != y]
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return map_batches(links.select("u", "v"), run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node of each connected component of links (a, b), by large-star and small-star steps."""
    links = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"))
    # Few links need few tasks; a task keeps the ends of its own links in memory.
    parts = links.count() // LINKS_IN_PART + 1
    edges = checkpointed(contracted(links.coalesce(parts)))
    if parts == 1:  # all links met in one task, so every node already has the smallest one that it can reach
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = state(edges)
    while True:
        # Large star: every larger neighbour of u is linked to the smallest in u's neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(parts)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(parts)
        # Small star: the smaller neighbours of u, and u, are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
        small = large.join(least, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = checkpointed(edges.coalesce(parts))
        # Both steps only lower the ends of links, so equal sums mean equal links.
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after


def near_links(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed links between classes. `rows`: doc_id, n_shingles, bands, signature of one document of each class."""
    cards = rows.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), F.col("signature").alias("sig"))
    spread = rows.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    flipped = [F.min(F.col("node").bitwiseXOR(F.lit(bits))).bitwiseXOR(F.lit(bits)).alias(f"flip{k}") for k, bits in enumerate(FLIPS)]
    shared = spread.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high"), *flipped).where("low < high")
    hubs = F.array("low", "high", *[f"flip{k}" for k in range(len(FLIPS))])
    shared = checkpointed(shared.select("bucket", "size", F.array_distinct(hubs).alias("hubs")))
    members = checkpointed(join_hot(spread, shared, ["bucket"], "size").where("hubs IS NOT NULL"))
    company = members.select(F.col("node").alias("doc_id")).distinct()
    cards = checkpointed(cards.join(company.withColumnRenamed("doc_id", "node"), "node"))
    pairs = members.select("node", F.explode("hubs").alias("hub")).where("node <> hub").distinct()
    # The hub of a bucket that a third of all documents share meets as many rows: such hubs are cut into parts.
    asked = checkpointed(pairs.groupBy("hub").agg(F.count("*").alias("rows")))
    held = cards.select(F.col("node").alias("hub"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    full = join_salted(pairs.join(cards.select("node", F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "node"), held, "hub", asked)
    full = full.withColumn("estimate", similarity_estimate(lanes_apart("sig_a", "sig_b"))).where(likely(F.col("estimate"), "n_a", "n_b")).select("node", "hub", "estimate")
    # A node has no more hubs than four for each band, so its window is short.
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("estimate"), "hub"))
    found = checkpointed(full.withColumn("place", place).where(F.col("place") <= STAR_CHECKS).select(F.col("node").alias("a"), F.col("hub").alias("b")))
    links = checkpointed(confirmed(found, few_texts(texts, found, found.count())))
    named = members.select("bucket", "node").join(components(links), "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("comp"))
    # Buckets whose members are all of one component have nothing left to say.
    ends = named.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n")).where("low < high").select("bucket", "n", F.col("n").alias("size"))
    open_ = join_hot(named, checkpointed(ends), ["bucket"], "n").where("size IS NOT NULL")
    return links.unionByName(links_in_blocks(open_, cards, texts))


def met_in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Deals each bucket's rows to its `blocks`, and gives each row to every pair (i, j) of blocks that its own is in."""
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(99)), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})


def sketched(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """comp, n, own and signatures of a group."""
    comp, n, own = (group.column(c).to_numpy() for c in ("comp", "n", "own"))
    sig = group.column("sig").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(comp), -1)
    return comp, n, own, sig


def partners(r: int, comp: np.ndarray, n: np.ndarray, own: np.ndarray, sig: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows behind r that are likely partners of r in another component, and in how many lanes each row behind r differs."""
    x = sig[r + 1 :] ^ sig[r]
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    apart = np.bitwise_count(x & np.uint64(sum(1 << k for k in range(0, 64, BITS)))).sum(axis=1)
    near = (apart <= HASHES - LEAST_LANES) & (100 * np.minimum(n[r], n[r + 1 :]) >= PERCENT * np.maximum(n[r], n[r + 1 :])) & (comp[r + 1 :] != comp[r])
    return (near & (own[r + 1 :] != own[r]) if cross else near), apart


def links_in_blocks(rows: DataFrame, cards: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed links between members (bucket, node, comp, size) of one bucket that are in different components."""

    def look(group: pa.Table) -> pa.Table:
        comp, n, own, sig = sketched(group)
        cross = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        live = np.zeros(len(comp), bool)
        for r in range(len(comp) - 1):
            near, _ = partners(r, comp, n, own, sig, cross)
            live[r] |= near.any()
            live[r + 1 :] |= near
        return group.select(["bucket", "node", "comp", "n", "sig"]).filter(pa.array(live))

    full = met_in_blocks(rows.join(cards, "node"), (F.col("size") / BLOCK_MEMBERS).cast("int") + 1)
    kind = "bucket long, node long, comp long, n long, sig array<long>"
    live = checkpointed(full.select("bucket", "node", "comp", "n", "sig", "own", "i", "j").groupBy("bucket", "i", "j").applyInArrow(look, kind).dropDuplicates(["bucket", "node"]))
    nodes = live.select("node").distinct()
    size = nodes.count()
    ids = nodes.withColumnRenamed("node", "doc_id")
    held = texts.join(F.broadcast(ids) if size <= BROADCAST_PAIRS else ids, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "raw")
    blocks = checkpointed(live.groupBy("bucket").agg(F.count("*").alias("rows"), (F.floor(F.sum("n") / BLOCK_SHINGLES) + 1).cast("int").alias("blocks")))
    met = met_in_blocks(join_hot(live, blocks, ["bucket"], "rows"), F.col("blocks")).join(held, "node").select("bucket", "node", "comp", "n", "sig", "own", "i", "j", "raw")

    def check(group: pa.Table) -> pa.Table:
        node, raw = group.column("node").to_pylist(), group.column("raw").to_pylist()
        comp, n, own, sig = sketched(group)
        cross = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        sets: dict[int, np.ndarray] = {}
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while (p := parent.get(c, c)) != c:
                c = p
            return c

        out_a, out_b = [], []
        for r in range(len(node) - 1):
            near, apart = partners(r, comp, n, own, sig, cross)
            for q in r + 1 + np.flatnonzero(near)[np.argsort(apart[near], kind="stable")]:
                a, b = root(int(comp[r])), root(int(comp[q]))
                if a == b:
                    continue
                for k in (r, int(q)):
                    if k not in sets:
                        sets[k] = shingles(raw[k])
                common = len(np.intersect1d(sets[r], sets[int(q)], assume_unique=True))
                if common and 100 * common >= PERCENT * (len(sets[r]) + len(sets[int(q)]) - common):
                    parent[max(a, b)] = min(a, b)
                    out_a.append(node[r])
                    out_b.append(node[q])
        return pa.table([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return met.groupBy("bucket", "i", "j").applyInArrow(check, "a long, b long").distinct()


def few_texts(texts: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The texts that the pairs name. Ids are broadcast only if they are few (the size is counted); else the joins that follow shuffle."""
    if size > BROADCAST_PAIRS:
        return texts
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    return texts.join(F.broadcast(ids), "doc_id", "left_semi")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = checkpointed(sketches(docs))
    known = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = checkpointed(known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    firsts = checkpointed(known.join(classes.select("digest", F.col("first").alias("doc_id")), ["digest", "doc_id"]).dropDuplicates(["digest"]).drop("digest"))
    links = near_links(firsts, docs.select("doc_id", F.col("text").cast("binary").alias("raw")))
    # An id whose rows have different texts ties their classes together.
    several = known.groupBy("doc_id").agg(F.min("digest").alias("one"), F.max("digest").alias("other")).where("one <> other").select("doc_id")
    tied = known.join(several, "doc_id").join(classes, "digest").select("doc_id", "first")
    tied = tied.join(tied.groupBy("doc_id").agg(F.min("first").alias("least")), "doc_id").select(F.col("first").alias("a"), F.col("least").alias("b"))
    found = checkpointed(classes.join(components(links.unionByName(tied)), F.col("first") == F.col("node"), "left").select("digest", "n", F.coalesce("component", "first").alias("of_class")))
    # Rows without a class get keys of their own, as null keys would meet in one task.
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).otherwise(F.uuid().cast("binary"))
    out = join_hot(rows.select("doc_id", "n_shingles", own.alias("digest")), found, ["digest"], "n")
    # Where no class is found, the text has no shingle; another row of the id may have some.
    bare = known.select("doc_id", "digest").join(rows.where("doc_id IS NOT NULL AND n_shingles = 0").select("doc_id").distinct(), "doc_id").join(found, "digest").groupBy("doc_id").agg(F.min("of_class").alias("of_id"))
    out = out.join(bare, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("of_class", "of_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group; of repeated rows of that id, the one of the smallest text. Rows with a null id stay."""
    verdict = checkpointed(near_duplicates(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("rows")))
    out = verdict.where("NOT kept OR rows > 1").select("doc_id")
    # Ids are broadcast only if they are few (counted); else the texts are shuffled to them.
    once = docs.join(F.broadcast(out) if out.count() <= BROADCAST_PAIRS else out, "doc_id", "left_anti")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    again = docs.join(verdict.where("kept AND rows > 1").select(F.col("doc_id")), "doc_id", "left_semi").withColumn("_place", place).where("_place = 1")
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))
