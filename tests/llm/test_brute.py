"""Each operator against a plain version of it, on small tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("tablewright.llm")
P = pytest.importorskip("public_tokenizers")

from tablewright.llm import decontamination, language_id, packing, quality, substring_dedup, token_counts, toxicity  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def few(spark, sf_dir):
    """Some whole documents of the smallest table, and odd ones."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    return rows + [(900, None), (901, ""), (902, "x"), (903, "\U0001f600 \x00 a  b\n\nc <s>"), (None, rows[0][1]), (904, rows[1][1]), (905, rows[1][1] + " and more of it"), (906, "ab" * 3000)]


@pytest.fixture(scope="module")
def table(spark, few):
    return spark.createDataFrame(few, "doc_id long, text string")


def test_packing_pieces(table, few):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in few:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 256 + 1
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    got = packing.pack(table, P.path("byte_bpe_50k.json"), capacity=256).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert all(offset == sum(n for o, n in spans if o < offset) and offset + n <= 256 for spans in by.values() for offset, n in spans)


def gear_chunks(raw):
    ends, last, h = [], 0, 0
    for k, byte in enumerate(raw, 1):
        h = ((h << 1) + int(substring_dedup.GEAR[byte])) & 0xFFFFFFFF
        if k - last == substring_dedup.MOST or (k - last >= substring_dedup.LEAST and not h & int(substring_dedup.MASK)):
            ends.append(k)
            last = k
    return ends + ([len(raw)] if last < len(raw) else [])


def plain_spans(rows):
    """For each row the repeated runs of chunks, each extended byte by byte beside the first place of its outer chunks in the smallest owner."""
    cut = {t: gear_chunks(t.encode()) for _, t in rows if t}
    owner = {}
    for i, t in rows:
        if i is not None and t:
            key = xxhash.xxh64_intdigest(t.encode(), 42)
            for a, b in itertools.pairwise([0, *cut[t]]):
                chunk = t.encode()[a:b]
                owner[chunk] = min(owner.get(chunk, (i, key - (key >> 63 << 64), a, t)), (i, key - (key >> 63 << 64), a, t))
    out = []
    for i, t in rows:
        raw, runs = (t or "").encode(), []
        for a, b in itertools.pairwise([0, *cut.get(t, [])]):
            if i is not None and owner[raw[a:b]][0] < i:
                runs = [*runs[:-1], (runs[-1][0], b, runs[-1][2], raw[a:b])] if runs and runs[-1][1] == a else [*runs, (a, b, raw[a:b], raw[a:b])]
        gone = set()
        spans = []
        for a, b, first, last in runs:
            (_, _, at, text), (_, _, to, other) = owner[first], owner[last]
            before, behind, to = text.encode()[:at], other.encode()[to + len(last) :], 0
            while to < min(substring_dedup.REACH, len(before), a) and before[-1 - to] == raw[a - 1 - to]:
                to += 1
            a, to = a - to, 0
            while to < min(substring_dedup.REACH, len(behind), len(raw) - b) and behind[to] == raw[b + to]:
                to += 1
            spans.append((a, b + to))
        for a, b in spans:
            gone |= set(range(a, b))
        runs = [[k for _, k in g] for _, g in itertools.groupby(enumerate(sorted(gone)), lambda p: p[1] - p[0])]
        out.append([(r[0], r[-1] + 1) for r in runs if len(r) >= substring_dedup.SPAN or len(r) == len(raw)])
    return out


def test_substring_dedup_rows(table, few):
    want = collections.Counter()
    for (i, t), gone in zip(few, plain_spans(few), strict=True):
        raw = (t or "").encode()
        kept = bytes(x for k, x in enumerate(raw) if not any(a <= k < b for a, b in gone))
        want[(i, len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    got = substring_dedup.dedup(table).collect()
    assert collections.Counter(tuple(r) for r in got) == want and any(r.n_removed for r in got)


def test_substring_hot_passage(spark):
    """One passage in most documents: its owner is asked by all of them, and all lose the whole of it."""
    rng = random.Random(12)
    some = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))
    passage = some(60)
    rows = [(k, f"{some(12)} {passage} {some(12)}") for k in range(1500)] + [(5000 + k, some(40)) for k in range(300)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == 0 and all(len(passage) <= got[k] <= len(passage) + 8 for k in range(1, 1500)) and not any(got[5000 + k] for k in range(300))


def test_substring_recall(spark):
    """Passages of 51 random words in fresh surroundings: nine bytes of ten go, and next to nothing else."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 11))) for _ in range(4000)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    passages = [some(51) for _ in range(400)]
    rows = [(2 * k + side, f"{some(rng.randrange(5, 90))} {p} {some(rng.randrange(5, 90))}") for k, p in enumerate(passages) for side in (0, 1)]
    kept = {r.doc_id: r for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    removed = [kept[2 * k + 1].n_removed / (len(p) + 2) for k, p in enumerate(passages)]
    assert sum(removed) / len(removed) >= 0.95 and sum(r == 0 for r in removed) <= 4
    assert all(kept[2 * k].n_removed == 0 and kept[2 * k + 1].n_removed <= len(p) + 10 for k, p in enumerate(passages))


def test_quality_scores(table, few):
    trusted = {i for i, _ in few if i is not None and i % 3 == 1}
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def grams(t):
        w = WORD.findall(t or "")
        one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
        two = [xxhash.xxh64_intdigest(y.encode(), a) for a, y in zip(one, [*w[1:], ""], strict=False)]
        return [signed(h) % quality.BUCKETS for h in one + two]

    raw, target = collections.Counter(), collections.Counter()
    for i, t in few:
        raw.update(grams(t))
        target.update(grams(t) if i in trusted else [])
    spread = quality.SMOOTHING * quality.BUCKETS
    ratio = lambda b: math.log((target[b] + quality.SMOOTHING) / (target.total() + spread)) - math.log((raw[b] + quality.SMOOTHING) / (raw.total() + spread))
    want = sorted((-1 if i is None else i, round(sum(map(ratio, g)) / len(g), 9) if (g := grams(t)) else 0.0) for i, t in few)
    ids = table.sparkSession.createDataFrame([(i,) for i in trusted], "doc_id long")
    out = quality.judge(table, ids).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, round(r.score, 9)) for r in out) == want
    assert all(r.kept == (not r.base_failed and r.score >= quality.THRESHOLD) for r in out)


def viterbi(text, pieces, low):
    """Best score and count for each end; a later start wins only by a larger score."""
    text = ("▁" + text.replace(" ", "▁")) if text else ""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for a in range(len(text)):
        for b in range(a + 1, len(text) + 1):
            if text[a:b] in pieces and (s := best[a][0] + pieces[text[a:b]]) > best[b][0]:
                best[b] = (s, best[a][1] + 1)
        if text[a] not in pieces and (s := best[a][0] + low) > best[a + 1][0]:
            best[a + 1] = (s, best[a][1] + len(text[a].encode()))
    return best[-1][1]


def test_token_counts_rows(spark, few):
    rng = random.Random(2)
    short = [(i, t[: rng.randrange(200)]) if t else (i, t) for i, t in few]
    pieces = {p: -rng.random() * 5 for _, t in short[:20] for k in range(0, len(t or ""), 3) for p in [(t or "")[k : k + rng.randrange(1, 5)].replace(" ", "▁")] if p}
    pieces |= {"▁": -3.0}
    out = token_counts.token_counts(spark.createDataFrame(short, "doc_id long, text string"), list(pieces.items())).collect()
    low = min(pieces.values()) - token_counts.UNKNOWN_PENALTY
    want = collections.Counter((i, viterbi(t or "", pieces, low)) for i, t in short)
    assert collections.Counter((r.doc_id, r.n_tokens) for r in out) == want


def test_string_kernel():
    """The listed subsequences' products equal the kernel by its definition."""

    def kernel(a, b):
        lists = []
        for w in (f"^{a}$", f"^{b}$"):
            weights = collections.Counter()
            for i, j, k in itertools.combinations(range(len(w)), 3):
                if k - i < toxicity.SPAN:
                    weights[w[i] + w[j] + w[k]] += toxicity.LAMBDA ** (k - i + 1)
            size = sum(toxicity.LAMBDA ** (2 * (k - i + 1)) for i, _, k in itertools.combinations(range(len(w)), 3) if k - i < toxicity.SPAN)
            lists.append((weights, max(1.0, size) ** 0.5))
        return sum(n * lists[1][0][s] for s, n in lists[0][0].items()) / (lists[0][1] * lists[1][1])

    words = ["idiot", "id.iot", "idiiot", "garden", "a", "moron"]
    feature, weight, word = toxicity.subsequences(words)
    full = np.zeros((len(words), toxicity.FEATURES))
    np.add.at(full, (word, feature), weight)
    want = [[kernel(a, b) for b in words] for a in words]
    assert np.abs(full @ full.T - np.array(want)).max() < 0.02 and want[0][1] > 3 * want[0][3]


def test_toxicity_on_held_out_documents(spark, sf_dir):
    path = sf_dir.replace("0.001", "0.1")
    truth = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic").where("toxic IS NOT NULL")
    out = toxicity.query(spark, path).where("held_out").join(truth, "doc_id").collect()
    hits = sum(r.predicted == 1 == r.toxic for r in out)
    assert len(out) > 500 and np.mean([r.predicted == r.toxic for r in out]) > 0.96
    assert hits > 0.85 * sum(r.toxic for r in out) and hits > 0.85 * sum(r.predicted for r in out)


def test_language_scores(table, few):
    model = language_id.train([t for _, t in few[:60]], [["a", "b"][k % 2] for k in range(60)])
    got = {r.doc_id: r for r in language_id.identify(table, model).collect()}
    for i, t in few[:65]:
        if i is None:
            continue
        words = re.findall(r"[^\W\d_]+", (t or "").lower())
        if not words:
            assert got[i].lang_pred == "und" and got[i].score == 0.0
            continue
        buckets = []
        for w in words:
            raw = b"<" + w.encode() + b">"
            buckets += [zlib.crc32(raw[k : k + n], n) % language_id.BUCKETS for n in language_id.GRAMS for k in range(len(raw) - n + 1)] + [zlib.crc32(raw) % language_id.BUCKETS]
        if max(map(len, words)) > language_id.PIECE:
            continue
        z = (model.weights[buckets].astype(float).mean(axis=0) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert abs(got[i].score - p.max()) < 1e-4 and got[i].lang_pred == model.languages[int(p.argmax())]


def test_decontamination_finds_every_copy(spark, sf_dir):
    """Whole benchmark items in clean texts: verbatim, with other white space, wrapped anew, and with other numbers."""
    rng = random.Random(8)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    clean = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    index, templates = decontamination.Index(items), decontamination.Templates()
    found = lambda t: {i for i, *_ in index.found(*next(templates([t])))}
    clean = [t for t in clean if not found(t)][:40]
    assert len(clean) > 20 and not any(text in t for _, text in items for t in clean)
    ways = {
        "verbatim": lambda t: t,
        "tabs": lambda t: t.replace(" ", "\t"),
        "crlf": lambda t: t.replace(" ", "\r\n"),
        "no-break": lambda t: t.replace(" ", " "),
        "wrapped": lambda t: "".join("\n" if c == " " and rng.random() < 0.2 else c for c in t),
    }
    for name, way in ways.items():
        hits = [i in found(rng.choice(clean) + " " + way(t) + " " + rng.choice(clean)) for i, t in items]
        assert np.mean(hits) == 1.0, name
    made = [(k, f"A train leaves {a} at {n} and meets {b} after {m} km, so how many minutes does the whole journey of {b} from {a} take in the end?") for k, (a, b, n, m) in enumerate([("Brno", "Anna", 9, 40), ("Oslo", "Karl", 7, 55)])]
    index = decontamination.Index(made)
    changed = made[0][1].replace("Brno", "Lyon").replace("Anna", "Marie").replace("9", "11").replace("40", "62")
    assert {i: exact for i, *_, exact in index.found(*next(templates([rng.choice(clean) + " " + changed])))}.get(0) is False
    df = spark.createDataFrame([(k, t) for k, t in enumerate(clean)] + [(100 + i, clean[0] + "\n" + t) for i, t in items], "doc_id long, text string")
    out = {r.doc_id: {x.item_id for x in r["items"]} for r in decontamination.matches(df, bench).collect()}
    assert all(not out[k] for k in range(len(clean))) and all(i in out[100 + i] for i, _ in items)


def test_pipeline_against_plain_steps(spark, sf_dir, tmp_path):
    """What each stage has to drop or change, planted in clean documents; packing must then hold exactly the documents that are left."""
    import corpus_pipeline

    rng = random.Random(3)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    index, templates = decontamination.Index([(r.item_id, r.text) for r in bench.collect()]), decontamination.Templates()
    seen, clean = set(), []
    for r in source.where("lang IS NOT NULL").orderBy("doc_id").collect():
        words = r.text.lower().split()
        grams = set(zip(*(words[k:] for k in range(5)), strict=False))
        if len(words) > 60 and len(grams & seen) < 0.3 * len(grams) and not index.found(*next(templates([r.text]))):
            clean.append((r.text, r.lang))
        seen |= grams
    rows = [(i, t, lang, "s", len(t)) for i, (t, lang) in enumerate(clean)]
    n = len(rows)
    near = " ".join(w if k % 40 else "changed" for k, w in enumerate(clean[1][0].split()))
    item = bench.first().text
    key = "9f2c4e1ab77d03c5e8a1f6b2d4c7908133aa55ee"
    planted = [(1000, clean[0][0]), (1001, near), (1002, " ".join(rng.sample(clean[2][0].split(), 40)) + " " + item), (1003, "12345 !!"), (1004, None), (1005, clean[3][0][:300] + f' token = "{key}" ' + clean[4][0][-300:])]
    rows += [(i, t, "en", "s", len(t or "")) for i, t in planted] + [rows[5]]
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    left = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert left == {*range(n), 1005}
    text = corpus_pipeline.STAGES[3][1](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).where("doc_id = 1005").first().text
    assert key not in text and "<SECRET>" in text
    full = packing.pack(spark.createDataFrame([(i, t) for i, t, *_ in rows[:n]] + [(1005, text)], "doc_id long, text string"), P.path("byte_bpe_50k.json"))
    shape = lambda df: collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert shape(out) == shape(full)
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    bench.write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_join_salted_is_a_join(spark):
    from tablewright.llm.common import join_salted

    rng = random.Random(6)
    left = [(k, rng.choice([1, 1, 1, 1, rng.randrange(2, 40)])) for k in range(5000)]
    right = [(k, "text %d" % k) for k in range(30)]
    frame = spark.createDataFrame(left, "a long, b long")
    counts = frame.groupBy("b").agg(F.count("*").alias("rows"))
    got = join_salted(frame, spark.createDataFrame(right, "b long, raw string"), "b", counts).select("a", "b", "raw").collect()
    names = dict(right)
    assert sorted(map(tuple, got)) == sorted((a, b, names[b]) for a, b in left if b in names)
    assert join_salted(frame.limit(0), spark.createDataFrame(right, "b long, raw string"), "b", counts.limit(0)).count() == 0


def reparameterised(text, rng):
    """The text with other numbers, names and units, each value always by the same other one."""
    other = {}
    units = ("km", "kg", "minutes", "dollars", "days")

    def change(m):
        word = m.group()
        if word not in other:
            if word[0].isdigit():
                new = str(rng.randrange(10, 9999))
            elif word in units:
                new = rng.choice([u for u in units if u != word and u not in other.values()] or [word])
            else:
                new = "".join(rng.choices("abcdefghijklmnop", k=6)).capitalize()
            while new in other.values():
                new += "7" if new[0].isdigit() else "q"
            other[word] = new
        return other[word]

    return re.sub(r"\d+|(?<=[a-z,] )[A-Z][a-z]+\b|(?<=\d )(?:km|kg|minutes|dollars|days)\b", change, text)


def test_recall_of_reparameterised_questions(spark):
    """Questions of many kinds of sentence with their numbers, names and units changed consistently, inside other text, are found; with slots that contradict one another, and in clean text, nothing is."""
    rng = random.Random(13)
    words = "the old river road leads past our quiet garden where people trade bread for letters every morning before school".split()
    templates = (
        "When {A} walks {n} km in {m} minutes and {B} walks {k} km in {m} minutes, by how many km is {A} ahead of {B} after {p} minutes?",
        "A shop run by {A} sells {n} kg of flour for {m} dollars; how much do {k} kg cost if {B} gets {p} dollars off the price?",
        "If {n} workers under {A} need {m} days for a wall, how many days do {k} workers under {B} need for {p} such walls?",
        "Yesterday {A} read {n} pages in {m} minutes while {B} read {k} pages, so who of them reads faster and by how many pages in {p} minutes?",
    )
    items = []
    for k in range(200):
        names = rng.sample(["Anna", "Boris", "Clara", "David", "Emil", "Fiona", "Greta", "Hugo"], 2)
        tail = " ".join(rng.choices(words, k=6))
        items.append((k, templates[k % 4].format(A=names[0], B=names[1], **dict(zip("nmkp", rng.sample(range(2, 900), 4), strict=True))) + " Think of how " + tail + "."))
    around = lambda: " ".join(rng.choices(words, k=30))
    copies = [(k, f"{around()}. {reparameterised(t, rng)} {around()}") for k, t in items]
    broken = [(1000 + k, around() + ". " + re.sub(r"\d+", lambda m: str(rng.randrange(1000, 9999)), re.sub(r"\b(Anna|Boris|Clara|David|Emil|Fiona|Greta|Hugo)\b", lambda m: "".join(rng.choices("abcdefgh", k=7)).capitalize(), t.split(" Think of")[0]))) for k, t in items]
    clean = [(2000 + k, " ".join(rng.choices(words, k=90))) for k in range(100)]
    assert all(c[1] != t and t not in c[1] for (_, t), c in zip(items, copies, strict=True))
    docs = spark.createDataFrame(copies + broken + clean, "doc_id long, text string")
    found = {r[0]: r[1] for r in decontamination.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect() for r in [(r.doc_id, {i.item_id: i.exact for i in r["items"]})]}
    hit = [found[k].get(k) for k, _ in items]
    assert sum(h is not None for h in hit) / len(hit) >= 0.95 and not any(hit)  # found, and never as an exact copy
    assert sum(bool(found[k]) for k, _ in clean) == 0
    # One name and number after another in place of the one that stood twice.
    assert sum(1000 + k in found and k in found[1000 + k] for k, t in items if k % 4 == 0) <= 5


def test_one_word_items_drop_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(1, "and she said yes to the river"), (2, "nothing here"), (3, "he asked what is 12 + 30 once")], SCHEMA.split(", lang")[0]).selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    spark.createDataFrame([(1, "yes"), (2, "What is 12 + 30?")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in decontamination.stage(spark, docs, str(tmp_path)).collect()} == {1, 2}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: (r.n_items, r.kept) for r in decontamination.query(spark, str(tmp_path)).collect()} == {1: (1, True), 2: (0, True), 3: (1, False)}
