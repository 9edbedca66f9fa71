"""The document operators against plain versions, and on rows that are unusual."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tablewright.llm")
P = pytest.importorskip("public_tokenizers")

from tablewright.llm import decontamination, language_id, near_dedup, packing, quality, secrets, substring_dedup, suffix_dedup, token_counts, toxicity  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(seed=3, n=40):
    rng = random.Random(seed)
    words = ["the", "of", "and", "house", "river", "stone", "quiet", "morning", "letter", "yellow", "bread", "garden", "über", "naïve", "señor", "été"]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(6)]
    out = []
    for i in range(n):
        w = base[i % 6].split()
        for _ in range(i // 12):
            w[rng.randrange(len(w))] = rng.choice(words) + str(rng.randrange(99))
        tail = " ".join(rng.choices(words, k=rng.randrange(0, 60)))
        out.append((i, " ".join(w) + (". " + tail if i % 3 == 0 else ""), ["en", "fr"][i % 2], "s", 0))
    return out


ODD = [(100, None, None, None, None), (101, "", "en", "s", 0), (102, "x", None, "s", 1), (103, "123 !! 456", "en", "s", 1), (104, " \t\n\r ", "en", "s", 1), (None, "the house of the river and the garden of the quiet morning", "en", "s", 1), (105, "a" * 30_000, "en", "s", 1), (106, "ab " * 5_000, "en", "s", 1), (107, "\U0001f600 \x00 <|endoftext|>   zero\x00", "en", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = rows_of() + ODD
    rows += [rows[0], rows[5], ODD[0]]  # repeated rows
    extra = F.lit("x")
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("Items", "score", "kept", "secrets", "rejected", "component_id", "block", "raw", "length"):
        df = df.withColumn(name, extra)
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_language(spark, docs, empty):
    model = language_id.fit(docs)
    out = language_id.identify(docs, model).select("doc_id", "text", "lang_pred", "score", "rejected").collect()
    assert len(out) == docs.count()
    for r in out:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    none = language_id.identify(docs, language_id.train([], []))
    assert {r.lang_pred for r in none.select("lang_pred").collect()} == {"und"}


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    out = language_id.query(spark, sf_dir.replace("0.001", "0.01")).where("held_out")
    truth = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "lang")
    hits = out.join(truth, "doc_id").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert hits > 0.97


def test_all_of_a_long_word_is_scored():
    rng = random.Random(4)
    for letters in ("abcdefgh", "天地玄黃宇宙洪荒", "aé天\U00020000"):
        for size in (1, 12, 40, 41, 80, 123):
            word = "".join(rng.choices(letters, k=size))
            raw = b"<" + word.encode() + b">"
            grams = collections.Counter(zlib.crc32(raw[i : i + n], n) % language_id.BUCKETS for n in language_id.GRAMS for i in range(len(raw) - n + 1))
            parts = language_id.words_of(word)
            got = collections.Counter(b for p in parts for b in language_id.subwords(p))
            got.subtract(grams)
            assert min(got.values()) >= 0 and sum(got.values()) == len(parts) == -(-size // language_id.PIECE)
    # Two languages that differ only behind the same 45 letters.
    texts = ["q" * 45 + "".join(rng.choices("abcd" if i % 2 else "wxyz", k=60)) for i in range(120)]
    model = language_id.train(texts[:100], [["w", "a"][i % 2] for i in range(100)])
    assert language_id.Scorer(model)(texts[100:])[0] == ["w", "a"] * 10


def test_rare_languages_are_learned(spark):
    docs = spark.createDataFrame([(i, "some words of a text", f"l{i % 230}", "s", 1) for i in range(1150)], SCHEMA)
    assert len(language_id.fit(docs, 460).languages) == 230


def brute_suffix(rows, length=50):
    seen = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                seen[w] = min(seen.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if i is not None:
            for k in range(len(b) - length + 1):
                if seen[b[k : k + length]] < i:
                    gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return repr(r)


def test_suffix_dedup_equals_brute_force(docs, plain, empty):
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_suffix(plain), key=key) and any(r[2] for r in got)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_combined_order_equals_sorted_suffixes():
    rng = random.Random(1)
    for trial in range(80):
        letters = rng.choice([b"ab", b"abcdefgh", b"\0\1\2", bytes(range(256))])
        texts = [bytes(rng.choices(letters, k=rng.randrange(0, 60))) for _ in range(rng.randrange(1, 12))]
        texts += [texts[0] * 3, texts[0], b"a" * 90] if trial % 3 == 0 else []
        order = suffix_dedup.corpus_order(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]), 3, 4)
        suffixes = [t[i:] for t in texts for i in range(len(t))]
        assert [suffixes[i] for i in order] == sorted(suffixes) and sorted(order.tolist()) == list(range(len(suffixes)))


def test_suffix_dedup_other_lengths(docs, plain):
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs, length=20, trigger=9).collect()]
    assert sorted(got, key=key) == sorted(brute_suffix(plain, 20), key=key)


def test_token_ids_equal_the_tokenizer():
    ids = packing.Ids(P.path("byte_bpe_50k.json"))
    texts = [t or "" for _, t, *_ in rows_of() + ODD] + ["a  b", " lead", "tail ", "it's  l'a don 't", "1 2\r\n 3", "tab\t x", "nbsp  y  z"]
    for t, got in zip(texts, ids(texts), strict=True):
        assert got.tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids, t[:40]


def test_packing_is_a_partition(docs, empty):
    out = packing.pack(docs, P.path("byte_bpe_50k.json"), capacity=64).collect()
    by = collections.defaultdict(list)
    for r in out:
        assert 0 < r.length <= 64
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= 1.02 * (sum(r.length for r in out) / 64) + 2
    assert packing.pack(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_plan_uses_every_length_exactly():
    rng = np.random.default_rng(1)
    for counts in (np.zeros(65, int), rng.integers(0, 50, 65), np.eye(65, dtype=int)[64] * 7, np.eye(65, dtype=int)[33] * 9):
        counts = counts.copy()
        counts[0] = 0
        plan = packing.plan_sequences(counts, 64)
        assert (sum((u * n for u, n in plan), np.zeros(65, int)) == counts).all()


def test_substring_dedup(spark, docs, empty):
    out = {r.doc_id: r for r in substring_dedup.dedup(docs).collect()}
    assert substring_dedup.dedup(docs).count() == docs.count() and substring_dedup.dedup(empty).count() == 0
    assert out[0].n_removed == 0 and out[6].n_removed > 300 and out[100].n_bytes == 0
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60))
    two = spark.createDataFrame([(1, "start " + passage), (2, "another beginning, longer: " + passage + " end")], "doc_id long, text string")
    kept = {r.doc_id: r for r in substring_dedup.dedup(two, with_text=True).collect()}
    assert kept[1].n_removed == 0 and kept[2].n_removed > 200 and kept[2].kept_text.startswith("another beginning")


def test_short_copies_of_whole_texts_go(spark):
    texts = ["x", "a short line", "one that is longer than a chunk but has fewer bytes than a span", "a short line and its own end"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts[:3] + texts)], SCHEMA)
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in substring_dedup.dedup(docs).collect()} == {i: (len(t), len(t) if 3 <= i < 6 else 0) for i, t in enumerate(texts[:3] + texts)}


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(2)
    raw = bytes(rng.choices(b"abcdefghij klmnop", k=20_000))
    ends = substring_dedup.borders(raw)
    assert ends[-1] == len(raw) and all(b - a <= substring_dedup.MOST for a, b in zip([0, *ends], ends, strict=False))

    def pieces(b):
        found = substring_dedup.borders(b)
        return {b[x:y] for x, y in zip([0, *found], found, strict=False)}

    assert len(pieces(raw) & pieces(b"inserted " + raw)) > 0.95 * len(pieces(raw))
    assert substring_dedup.borders(b"") == []


def test_toxicity(spark, docs, empty):
    rng = random.Random(4)
    words = ["the", "house", "river", "stone", "quiet", "morning", "bread", "garden", "yellow", "letter"]
    texts = [(i, " ".join(rng.choices(words, k=20)) + (" idiot" if i % 2 else ""), i % 2) for i in range(200)]
    model = toxicity.train([t for _, t, _ in texts], [y for *_, y in texts])
    scorer = toxicity.Scorer(model)
    bad, gapped, spaced, good, none = scorer(["the idiot house", "the idi-ot house", "you i d i o t", "the quiet house", None])
    assert bad > 0.5 > good and spaced > 0.5 and gapped > good and none <= 0.5
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(1, "If Maria Lopez runs 5 km in 30 minutes, how far does she run in 60 minutes at the same pace as before?"), (2, None), (3, ""), (4, "too short"), (None, "no id at all here friends")], "item_id long, text string")
    text = "Well. If Peter Lopez runs 7 km in 35 minutes, how far does she run in 70 minutes at the same pace as before? Yes"
    more = spark.createDataFrame([(1, text), (2, text.replace("70", "71").replace("Peter", "Anna")), (3, "a clean text about bread and the river")], "doc_id long, text string")
    got = {r.doc_id: r.items_ for r in decontamination.matches(more, bench).withColumnRenamed("items", "items_").collect()}
    assert [(i.item_id, i.exact) for i in got[1]] == [(1, False)] and got[3] == []
    assert decontamination.matches(docs, bench).count() == docs.count() and decontamination.matches(empty, bench).count() == 0
    assert decontamination.matches(docs, bench.limit(0)).where(F.size("items") > 0).count() == 0
    # Blocks of another size give the same result.
    assert {r.doc_id: r.items_ for r in decontamination.matches(more, bench, block_chars=40).withColumnRenamed("items", "items_").collect()} == got


def test_slots_must_be_consistent():
    index = decontamination.Index([(1, "give 12 apples to Anna and 12 pears to Anna and then count 12 of them again")])
    templates = decontamination.Templates()
    find = lambda t: index.found(*next(templates([t])))
    assert find("give 15 apples to Mara and 15 pears to Mara and then count 15 of them again")[0][4] is False
    whole = find("give 12 apples to Anna and 12 pears to Anna and then count 12 of them again")[0]
    mixed = find("give 15 apples to Mara and 16 pears to Mara and then count 17 of them again")
    assert whole[4] is True and (not mixed or mixed[0][1] < whole[1])


def test_items_with_names_numbers_few_words_or_other_spaces():
    items = {
        1: "Tom has 3 apples. Tom buys 5 more. How many apples does Tom have?",
        2: "What is 12 + 30?",
        3: "小明有很多苹果和梨",
        4: "Compute 12 + 30 * 7 - 4 + 18 and then divide by 6",
        5: "the grey river runs behind our old garden in the quiet morning",
        6: "Paris",
    }
    index, templates = decontamination.Index(list(items.items())), decontamination.Templates()
    find = lambda t: {i: exact for i, *_, exact in index.found(*next(templates([t])))}
    for i, text in items.items():  # verbatim, inside other text
        assert find("So they say. " + text + " Then they left.") == {i: True}
    assert find("Anna has 4 apples. Anna buys 9 more. How many apples does Anna have?") == {1: False}
    assert find("well, tom has 3 apples. Tom buys 5 more. How many apples does Tom have?").keys() == {1}
    assert find("and what is 12 + 30? He said") == {2: True} and find("what is 12 + 31?") == {}
    assert find("昨天小明有很多苹果和梨。今天没有") == {3: True}
    assert find("compute 13 + 31 * 8 - 5 + 19 and then divide by 9") == {4: False}
    assert find("compute 13 + 31 * 8 - 8 + 19 and then divide by 9 or 13 31 8 5") == {}  # one number for two
    assert find(items[5].replace(" ", "\t")) == find(items[5].replace(" ", "\u00a0")) == {5: True}
    assert find("1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16") == find("") == {}


def base_counts(text):
    w = WORD.findall(text or "")
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for k in range(len(w) - 2) if grams[(w[k], w[k + 1], w[k + 2])] > 1 for j in (k, k + 1, k + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality(spark, docs, plain, empty):
    labels = spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(40)] + [(None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(200, "one line\none line\n \n \na | b # c\none line"), (201, "x y z x y z w x y z")], "doc_id long, text string"))
    out = quality.judge(more, quality.trusted_ids(labels)).collect()
    want = sorted((i, *base_counts(t)) for i, t in [(r.doc_id if r.doc_id is not None else -1, r.text) for r in more.collect()])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == want
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)
    assert quality.judge(empty, quality.trusted_ids(labels)).count() == 0
    assert {r.score for r in quality.judge(docs, quality.trusted_ids(labels.limit(0))).collect()} == {0.0}


def test_every_trusted_document_counts(spark, docs, plain):
    # More trusted ids than any fixed sample holds; those that the table has are spread over all of them.
    trusted = spark.range(30_000).select(F.col("id").alias("doc_id"))
    owned = [(i is not None, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in plain]
    all_raw, all_target = 2 * sum(len(w) for _, w in owned), 2 * sum(len(w) for known, w in owned if known)
    whole = {r.bucket: (r.raw, r.target) for r in quality.bucket_counts(docs, trusted).collect()}
    assert (sum(r for r, _ in whole.values()), sum(t for _, t in whole.values())) == (all_raw, all_target)
    assert {r.bucket: (r.raw, r.target) for r in quality.bucket_counts(docs, trusted, 7_000).collect()} == whole
    ratios = [quality.log_ratios(docs, trusted, n).first()["ratios"] for n in (1 << 30, 7_000)]
    assert ratios[0] == ratios[1]
    spread = quality.SMOOTHING * quality.BUCKETS
    for k in (0, *list(whole)[:20]):
        raw, target = whole.get(k, (0, 0))
        expected = np.log((target + quality.SMOOTHING) / (all_target + spread)) - np.log((raw + quality.SMOOTHING) / (all_raw + spread))
        assert abs(ratios[0][k] - expected) < 1e-12


def brute_near(rows):
    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = collections.defaultdict(list)
    for i, t in rows:
        w = WORD.findall((t or "").translate(table))
        sets[i].append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    ids = sorted(i for i in sets if i is not None)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= 75 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_near_dedup_equals_brute_force(docs, plain, empty):
    out = near_dedup.near_duplicates(docs).collect()
    assert len(out) == docs.count() and near_dedup.near_duplicates(empty).count() == 0
    want = brute_near(plain)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == want and len(set(want.values())) < len(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out if r.doc_id is not None)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 160)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert all(got.get(x, x) == root(x) for x in parent)


def test_signature_estimates_similarity():
    a = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64))
    b = np.sort(np.r_[a[:800], np.random.default_rng(2).integers(0, 1 << 63, 200, dtype=np.uint64)])
    x, y = (np.array(near_dedup.sketch(s)[2], np.int64).view(np.uint64) for s in (a, b))
    lanes = x ^ y
    lanes |= lanes >> np.uint64(1)
    lanes |= lanes >> np.uint64(2)
    apart = int(np.bitwise_count(lanes & np.uint64(0x1111111111111111)).sum())
    agree = 1 - apart / near_dedup.HASHES
    assert abs((agree - 2.0**-near_dedup.BITS) / (1 - 2.0**-near_dedup.BITS) - 800 / 1200) < 0.17


def test_token_counts_equal_the_tokenizer():
    from tokenizers import Tokenizer, models

    pieces = token_counts.read_pieces(P.path("piece_bpe_32k.model"))
    low = min(s for _, s in pieces)
    whole = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *((f"<0x{i:02X}>", low) for i in range(256))], 0, True))
    count = token_counts.Counter(pieces)
    for t in [t for _, t, *_ in rows_of()[:10]] + ["", "x", "a  b\n\nc", "日本語 \U0001f600 é", " lead tail ", "aaaaaaa bbbbb"]:
        assert count(t) == (len(whole.encode("▁" + t.replace(" ", "▁")).ids) if t else 0), t
    assert count(None) == 0


def test_ties_prefer_the_longest_piece():
    counter = token_counts.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0)])
    assert counter("ab") == 2  # the space, then `ab` rather than `a`, `b`
    assert token_counts.Counter([("a", -1.0)], byte_fallback=False)("zzaz") == 3


def test_token_counts_table(docs, empty):
    pieces = [("▁the", -1.0), ("▁", -2.0), ("t", -3.0), ("h", -3.0), ("e", -3.0)]
    assert token_counts.token_counts(docs, pieces).count() == docs.count() and token_counts.token_counts(empty, pieces).count() == 0


def test_join_with_hot_keys(spark, monkeypatch):
    from tablewright.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 4)
    left = spark.createDataFrame([(i, 7 if i % 2 else i, b"x" * (i % 3)) for i in range(60)], "i long, k long, d binary")
    for on in (["k"], ["d"], ["k", "d"]):
        right = left.where("i > 3").groupBy(*on).agg(F.min("i").alias("least"))
        right = right.join(left.groupBy(*on).agg(F.count("*").alias("n")), on).select(*on, "n", "least")
        got = sorted((r.i, r.least) for r in common.join_hot(left, right, on, "n").collect())
        assert got == sorted((r.i, r.least) for r in left.join(right, on, "left").collect()) and len(got) == 60


def test_secrets(spark, docs, empty):
    key = "9f2c4e1ab77d03c5e8a1f6b2d4c7908133aa55ee"
    rows = [(1, f'the house token = "{key}" of the river', "en", "s", 0), (2, "write to anna.lee42@mail7.example.com about the morning", "en", "s", 0), (3, f"checksum sha1 {key} of the garden", "en", "s", 0), (4, None, None, None, None)]
    model = secrets.fit(docs)
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in secrets.redact(secrets.scan(df, model)).collect()}
    assert out[1].text == 'the house token = "<SECRET>" of the river' and out[2].text == rows[1][1] and out[3].text == rows[2][1] and out[4].text is None
    assert secrets.scan(docs, model).count() == docs.count() and secrets.scan(empty, secrets.fit(empty)).count() == 0


def test_other_forms_of_secrets():
    model = secrets.train(secrets.read_findings(), frozenset({"quiet", "river", "house", "config"}))
    show = lambda t: [t[a:b] for a, b, _ in model.spans(t)[1]]
    assert show('the password = "h8nter2!x" of the river') == ["h8nter2!x"] and show("postgres://app:Xk2#mQ9$vL@db.example.com/x") == ["Xk2#mQ9$vL"]
    assert show('the password = "<password>" of') == show("see the monkey: house") == show("a quiet river by the house") == []
    spans = secrets.candidates("token=abcdefghijklmnopqrstuvwxyz0123456789 key: " + "z9" * 40_000)
    assert [b - a for a, b in spans] == [36, 80_000]


def test_forest_on_findings_it_has_not_seen():
    findings = secrets.read_findings()
    precision, recall = secrets.held_out_quality(secrets.train(findings, frozenset()), findings)
    assert precision > 0.9 and recall > 0.9
    assert secrets.train([], frozenset()).spans("token = 0123456789abcdef0123456789abcdef")[1] == []


def test_dictionary_counts_all_documents(spark, docs, plain, empty):
    seen = collections.Counter(w for _, t in plain for w in {x for x in re.findall(r"[^\W\d_]+", (t or "").lower()) if 4 <= len(x) <= 12})
    assert secrets.dictionary(docs) == {w for w, n in seen.items() if n > 1} and secrets.dictionary(empty) == frozenset()
    some = secrets.dictionary(docs, 12)
    assert 0 < len(some) <= 12 and min(seen[w] for w in some) > max(seen[w] for w in seen if w not in some)


def test_tokens_of_the_test_table_are_found(spark, sf_dir):
    """Against a plain version: the documents' secrets are 40 hex digits behind `token = `."""
    path = sf_dir.replace("0.001", "0.01")
    got = {r.doc_id: sorted((x.start, x.end) for x in r.secrets) for r in secrets.query(spark, path).collect()}
    rows = spark.read.parquet(path + "/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: sorted(m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r.text or "")) for r in rows}
    hits = sum(len(set(got[i]) & set(want[i])) for i in want)
    assert got.keys() == want.keys() and hits == sum(map(len, want.values())) > 5 and sum(map(len, got.values())) <= hits + 1


def test_pipeline_stages(spark, docs, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]
    at = spark.createDataFrame(rows_of(), SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, at, sf_dir)
        assert new.columns == at.columns and new.count() <= at.count()
        at = new
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_folds(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    from tablewright.llm.common import held_out

    got = {r.doc_id: r.h for r in df.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(got[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(50)) and got[None] is False
