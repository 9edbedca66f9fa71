"""Quality rules: base counts of a text and a log-likelihood ratio between trusted and raw text.

Two multinomials over hashed buckets of word unigrams and bigrams: one fitted on all trusted documents, one counted
over all documents. A document's score is the mean, over its n-grams, of the logarithm of the ratio of
the two smoothed probabilities; the mean makes long and short texts comparable. A document is kept if its base
rules hold and its score reaches the threshold: the same rows are kept in every run.

Only built-in functions are used. Counting aggregates within tasks to at most BUCKETS rows; the ratios come
back as one array of BUCKETS numbers, whose size does not depend on the data, so scoring needs no shuffle. Trusted ids are
broadcast in blocks of a counted size, one after the other: the first pass counts every document and the first block,
each further pass only the documents of its block, so no text is shuffled and each is cut into words once for each side.

Null text counts as empty: no word, so base_failed. A text without n-grams scores 0. Repeated rows are judged
each. Without trusted documents the two multinomials are taken as equal, so every score is 0. A document with
a null id is judged but never trusted. Labels that repeat an id count once; one bad label is enough to distrust. A score that equals the threshold
is kept. Very long texts are judged whole; an empty table gives no row. Other columns of the caller are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import table

BUCKETS = 1 << 14
SMOOTHING = 0.5
THRESHOLD = -0.05
#: Trusted ids in one broadcast, in expectation.
BLOCK_IDS = 1_000_000
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def removed(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda s: F.trim(s, F.lit(" \t\x0b\x0c\r")) != "")
    return F.size(lines) - F.size(F.array_distinct(lines))


def repeated_positions(order: Column) -> Column:
    """Positions, ascending, of the elements of `order` (sorted (h, i)) whose h equals a neighbour's: the 3-word
    windows found twice or more. Each at p covers words p to p + 2, less those that the next one covers."""
    last = F.size(order) - 1
    own = F.filter(F.sequence(F.lit(0), last), lambda k: ((k > 0) & (F.get(order, k - 1)["h"] == F.get(order, k)["h"])) | ((k < last) & (F.get(order, k + 1)["h"] == F.get(order, k)["h"])))
    return F.sort_array(F.transform(own, lambda k: F.get(order, k)["i"]))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, words, and the base counts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", text.alias("text")).withColumn("words", words_of(F.col("text")))
    n = F.size("words")
    df = df.withColumn(
        "windows",
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).otherwise(F.array().cast("array<bigint>")),
    )
    # Most texts repeat nothing; only those that do are sorted with positions.
    df = df.withColumn("order", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("at", F.when(F.col("order").isNotNull(), repeated_positions(F.col("order"))))
    covered = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return df.select(
        "doc_id",
        "words",
        long(n).alias("n_words"),
        long(F.char_length(removed(F.col("text"), " \t\n\x0b\x0c\r"))).alias("word_chars"),
        long(F.char_length("text") - F.char_length(removed(F.col("text"), SYMBOLS))).alias("n_symbols"),
        long(n_dup_lines(F.col("text"))).alias("n_dup_lines"),
        long(covered).alias("n_repeat_words"),
    )


def buckets(words: Column) -> Column:
    """Buckets of the unigrams and of the bigrams of a list of words."""
    of = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    ones = F.transform(words, lambda w: of(F.xxhash64(w)))
    twos = F.transform(words, lambda w, i: of(F.xxhash64(w, F.coalesce(F.get(words, i + 1), F.lit("")))))
    return F.concat(ones, twos)


def counted(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """bucket, raw, target: n-grams of the documents that the join with the trusted `ids` gives, and of the trusted ones."""
    marked = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids.withColumn("trusted", F.lit(1))), "doc_id", how)
    split = marked.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), words_of(F.coalesce("text", F.lit(""))).alias("words"))
    grams = split.select("trusted", F.explode(buckets(F.col("words"))).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))


def bucket_counts(docs: DataFrame, trusted: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """bucket, raw, target: n-grams of all documents and of all trusted ones. At most BUCKETS rows come to the driver for each block."""
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    n = max(1, -(-ids.count() // block_ids))
    if n == 1:
        return counted(docs, ids, "left")
    totals: dict[int, list[int]] = {}
    for b in range(n):
        block = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) == b)
        for r in counted(docs, block, "inner" if b else "left").collect():
            total = totals.setdefault(r["bucket"], [0, 0])
            total[0] += 0 if b else r["raw"]
            total[1] += r["target"]
    return docs.sparkSession.createDataFrame([(k, *v) for k, v in totals.items()], "bucket int, raw long, target long")


def log_ratios(docs: DataFrame, trusted: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row: an array with the log ratio of each bucket. `trusted`: doc_id of trusted documents."""
    counts = bucket_counts(docs, trusted, block_ids)
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    gathered = full.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("rows"), F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    spread = SMOOTHING * BUCKETS
    ratio = lambda r: F.when(F.col("all_target") == 0, F.lit(0.0)).otherwise(
        F.log((r["target"] + SMOOTHING) / (F.col("all_target") + spread)) - F.log((r["raw"] + SMOOTHING) / (F.col("all_raw") + spread))
    )
    return gathered.select(F.transform("rows", ratio).alias("ratios"))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base counts, base_failed, kept, score: one row for each row of `docs`."""
    scored = base_counts(docs).crossJoin(F.broadcast(log_ratios(docs, trusted)))  # one row on the right
    grams = buckets(F.col("words"))
    score = F.when(F.size("words") == 0, F.lit(0.0)).otherwise(F.aggregate(grams, F.lit(0.0), lambda s, b: s + F.get("ratios", b)) / (2 * F.size("words")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), score.alias("score")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
