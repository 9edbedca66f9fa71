"""Label tables, set-valued metrics, review samples and frozen cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_labels(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """A wide csv (field_state, field_value, field_notes), or json lines with a map `labels` of field to state, value and notes, as long rows.
    Fields that a file lacks, as older versions do, come as `unlabeled`."""
    if path.endswith(("json", "jsonl")):
        kind = "struct<state:string,value:string,notes:string>"
        rows = spark.read.schema(f"job_id string, labels map<string,{kind}>").json(path)
        label = lambda f: F.coalesce(F.element_at("labels", F.lit(f)), F.lit(None).cast(kind))
        each = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(label(f)["state"], F.lit("unlabeled")).alias("state"), label(f)["value"].alias("value"), label(f)["notes"].alias("notes")) for f in fields])
        return rows.select("job_id", F.inline(each))
    return unpivot_labels(spark.read.csv(path, header=True), "job_id", fields, notes=True)


def unpivot_labels(wide: DataFrame, by: str, fields: list[str], notes: bool = False) -> DataFrame:
    have = {c.lower() for c in wide.columns}
    pick = lambda c: F.col(c).cast("string") if c.lower() in have else F.lit(None).cast("string")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(pick(f"{f}_state"), F.lit("unlabeled")).alias("state"), pick(f"{f}_value").alias("value"), *([pick(f"{f}_notes").alias("notes")] if notes else [])) for f in fields])
    return wide.select(F.col(by), F.inline(each))


def label_metrics(gold: DataFrame, predicted: DataFrame, by: str) -> DataFrame:
    """Gold (by, field, state, values) against predicted (by, field, state, values). Only gold states known and not_mentioned count."""
    g = gold.where("state IN ('known', 'not_mentioned')").select(by, "field", F.col("values").alias("g"))
    p = predicted.select(by, "field", F.col("state").alias("p_state"), F.col("values").alias("p"))
    j = g.join(p, [by, "field"], "left").withColumn("p", F.coalesce("p", F.array().cast("array<string>")))
    size = lambda c: F.sum(F.size(c))
    out = j.groupBy("field").agg(
        F.count("*").alias("labeled"), F.count_if(F.size("p") > 0).alias("emitted"), F.count_if(F.coalesce(F.col("p_state") == "conflict", F.lit(False))).alias("conflicts"),
        size(F.array_intersect("g", "p")).alias("tp"), size(F.array_except("p", "g")).alias("fp"), size(F.array_except("g", "p")).alias("fn"),
    )
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 9))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn), "coverage": ratio(F.col("emitted"), F.col("labeled"))})


def language_metrics(gold: DataFrame, predicted: DataFrame, by: str, mode: str) -> DataFrame:
    """Metrics on one side of language tokens `language:requirement:level`: presence, requirement or cefr; tokens without that side are not scored."""
    part = {"presence": 1, "requirement": 2, "cefr": 3}[mode]
    side = lambda c: F.array_distinct(F.filter(F.transform(c, lambda t: F.when(F.split_part(t, F.lit(":"), F.lit(part)) != "", F.concat_ws(":", F.split_part(t, F.lit(":"), F.lit(1)), F.split_part(t, F.lit(":"), F.lit(part))))), lambda t: t.isNotNull()))
    cut = lambda df: df.withColumn("values", side(F.col("values"))).withColumn("field", F.lit(mode))
    return label_metrics(cut(gold), cut(predicted), by)


def label_tokens(values: Column, keys: list[str]) -> Column:
    """Structs as canonical text tokens, distinct and in order."""
    return F.sort_array(F.array_distinct(F.transform(values, lambda v: F.concat_ws(":", *[F.coalesce(v[k].cast("string"), F.lit("")) for k in keys]))))


#: States of a label, and the words that its fields allow.
LABEL_STATES = ("unlabeled", "known", "not_mentioned", "unknown", "conflict", "ambiguous")
LABEL_WORDS = {"requirement": ("required", "preferred", "unknown"), "cefr": ("A1", "A2", "B1", "B2", "C1", "C2"), "period": ("hour", "day", "month", "year", "task", "one_time", "unknown"), "basis": ("gross", "net", "unknown"), "component": ("base", "bonus", "equity", "task_reward", "other", "unknown")}


def check_labels(labels: DataFrame, by: str, states: tuple[str, ...] = LABEL_STATES, words: dict[str, tuple[str, ...]] | None = None, ranges: dict[str, tuple[str, str, float]] | None = None, reviewers: bool = False) -> DataFrame:
    """Violations (by, field, problem) of labels (by, field, state, value): states, values where none may be, fields whose value is none of
    their `words`, `ranges` (field to two columns and the largest value) out of order, reviews without a reviewer, and labels given twice."""
    tests = [
        ("unknown_state", ~F.coalesce(F.col("state").isin(*states), F.lit(False))),
        ("known_without_value", (F.col("state") == "known") & (F.coalesce(F.trim("value"), F.lit("")) == "")),
        ("value_without_knowledge", (F.col("state") != "known") & F.col("value").isNotNull()),
    ]
    tests += [(f"unknown_{field}", (F.col("field") == field) & F.col("value").isNotNull() & ~F.col("value").isin(*allowed)) for field, allowed in (words or {}).items()]
    tests += [(f"{field}_out_of_range", (F.col("field") == field) & ((F.col(high) < F.col(low)) | (F.col(low) < 0) | (F.greatest(low, high) > most))) for field, (low, high, most) in (ranges or {}).items()]
    if reviewers:
        tests.append(("reviewer_missing", F.coalesce(F.trim("reviewer_id"), F.lit("")) == ""))
    problems = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in tests]))
    plain = labels.select(by, "field", F.explode(problems).alias("problem"))
    key = [by, "field", *(["reviewer_id"] if reviewers else [])]
    return plain.unionByName(labels.groupBy(*key).count().where("count > 1").select(by, "field", F.lit("duplicate_label").alias("problem")))


def labels_with_predictions(labels: DataFrame, predictions: DataFrame, by: str) -> DataFrame:
    """Labels with the prediction of the same input; `stale` where the digests differ."""
    p = predictions.select(by, F.col("input_hash").alias("_hash"), "prediction")
    return labels.join(p, by).withColumn("stale", F.col("input_hash") != F.col("_hash")).drop("_hash")


def review_sample(rows: DataFrame, id_col: str, source: str, strata: list[str], count: int, quota: int, seed: str) -> DataFrame:
    """At least `quota` rows of each source, filled to `count` by rarity. A row weighs the sum of 1 / frequency of its strata; ties go by a
    seeded hash. Ranks are cut within salts first, so no source is sorted in one task."""
    weighted = rows
    for s in strata:
        n = rows.groupBy(s).agg(F.count("*").alias(f"_n_{s}"))
        weighted = weighted.join(n, s, "left")
    weight = sum((1 / F.col(f"_n_{s}") for s in strata[1:]), 1 / F.col(f"_n_{strata[0]}"))
    scored = weighted.withColumns({"_w": F.round(weight, 9), "_h": F.sha2(F.concat(F.lit(seed), F.col(id_col).cast("string")), 256)})
    order = [F.desc("_w"), F.col("_h")]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(64)))
    local = salted.withColumn("_r", F.row_number().over(Window.partitionBy(source, "_salt").orderBy(*order))).where(F.col("_r") <= quota)
    first = local.withColumn("_r", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("_r") <= quota).select(id_col, "_w", "_h")
    rest = scored.join(first.select(id_col), id_col, "left_anti").orderBy(*order).limit(count).select(id_col, "_w", "_h")
    both = first.withColumn("_first", F.lit(0)).unionByName(rest.withColumn("_first", F.lit(1)))
    return both.orderBy("_first", *order).limit(count).select(id_col)


def reserve_special(rows: DataFrame, special: Column, id_col: str, k: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(k special rows by seeded hash, everything else)."""
    by = F.sha2(F.concat(F.lit(seed), F.col(id_col).cast("string")), 256)
    kept = rows.where(special).orderBy(by).limit(k)
    return kept, rows.join(kept.select(id_col), id_col, "left_anti")


def cohort_manifest(rows: DataFrame, strata: list[str]) -> DataFrame:
    """Counts of each stratum's values."""
    each = F.array(*[F.struct(F.lit(s).alias("stratum"), F.col(s).cast("string").alias("value")) for s in strata])
    return rows.select(F.inline(each)).groupBy("stratum", "value").agg(F.count("*").alias("n"))


def population_hash(rows: DataFrame, id_col: str, parts: int = 1024) -> DataFrame:
    """One row: count and a digest of the set of ids that does not depend on their order. Ids are digested part by part (a part is a share of
    their own digests, so parts are in one order), then the parts."""
    own = rows.select(F.sha2(F.col(id_col).cast("string"), 256).alias("h")).distinct()
    part = own.groupBy(F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), F.lit(parts)).alias("part")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("p"), F.count("*").alias("n"))
    return part.agg(F.sum("n").alias("n"), F.sha2(F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("part", "p"))), lambda x: x["p"])), 256).alias("population_hash"))


def freeze_cohort(rows: DataFrame, id_col: str, source: str, strata: list[str], input_hash: str, special: Column, k: int, count: int, quota: int, seed: str) -> DataFrame:
    """A sample frozen with the digest of each row's input: k special rows first, the rest sampled (T03); an id stands in it once."""
    kept, others = reserve_special(rows, special, id_col, k, seed)
    rest = review_sample(others, id_col, source, strata, count - k, quota, seed)
    chosen = kept.select(id_col).withColumn("reserved", F.lit(True)).unionByName(rest.select(id_col).withColumn("reserved", F.lit(False)))
    return chosen.join(rows.select(id_col, F.col(input_hash).alias("input_hash"), *strata), id_col)


def check_cohort(frozen: DataFrame, now_: DataFrame, id_col: str, count: int) -> DataFrame:
    """Violations of a frozen cohort: repeated ids, rows that are gone or whose input changed, and a size other than the one asked for."""
    twice = frozen.groupBy(id_col).count().where("count > 1").select(F.col(id_col).cast("string").alias("subject"), F.lit("duplicate_member").alias("problem"))
    j = frozen.join(now_.select(id_col, F.col("input_hash").alias("_now")), id_col, "left")
    moved = j.select(F.col(id_col).cast("string").alias("subject"), F.when(F.col("_now").isNull(), "member_missing").when(F.col("_now") != F.col("input_hash"), "input_changed").alias("problem")).where("problem IS NOT NULL")
    size = frozen.agg(F.count("*").alias("n")).where(F.col("n") != count).select(F.col("n").cast("string").alias("subject"), F.lit("cohort_size").alias("problem"))
    return twice.unionByName(moved).unionByName(size)


def coverage_baseline(profiles: DataFrame, by: str, fields: list[str], evidence: DataFrame) -> DataFrame:
    """G17 over whole profiles: which kind of evidence (evidence_id, method) won each known field."""
    from tablewright.operators.profiles import coverage_matrix

    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"profile.{f}.state").alias("state"), F.get(F.col(f"profile.{f}.evidence_ids"), F.lit(0)).alias("evidence_id")) for f in fields])
    won = profiles.select(F.col(by), F.inline(each)).join(evidence.select("evidence_id", "method").dropDuplicates(["evidence_id"]), "evidence_id", "left")
    kind = F.when(F.col("state") == "conflict", "conflict").when(F.col("state") == "known", F.coalesce("method", F.lit("native"))).otherwise("unknown")
    return coverage_matrix(won.withColumn("kind", kind))


def evaluation_report(gold: DataFrame, predicted: DataFrame, by: str, languages: str = "languages") -> DataFrame:
    """G18 of every field, with the three readings of G19 for the field of languages."""
    out = label_metrics(gold.where(F.col("field") != languages), predicted.where(F.col("field") != languages), by)
    for mode in ("presence", "requirement", "cefr"):
        one = language_metrics(gold.where(F.col("field") == languages), predicted.where(F.col("field") == languages), by, mode)
        out = out.unionByName(one.withColumn("field", F.lit(f"{languages}_{mode}")))
    return out


def prediction_view(profiles: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """A profile's facts as long rows (by, field, state, value)."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"profile.{f}.state").alias("state"), F.col(f"profile.{f}.value").alias("value")) for f in fields])
    return profiles.select(F.col(by), F.inline(each))
