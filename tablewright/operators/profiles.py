"""Evidence, fact and description selection, fingerprints, assembly, incremental layers and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def build_evidence(matches: DataFrame, key: list[str]) -> DataFrame:
    """An id from the content of each piece of evidence; equal content is one piece."""
    content = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in key]), {"ignoreNullFields": "false"})
    return matches.withColumn("evidence_id", F.sha2(content, 256)).dropDuplicates(["evidence_id"])


def select_fact(candidates: DataFrame, by: list[str]) -> DataFrame:
    """Candidates (by, value, score, active, evidence_id) to one fact. Disagreement among the best makes a conflict: value null,
    evidence of all candidates kept in rank order (a fact holds the ids of its own evidence, as many as its job states). Only a source known to be inactive ranks lower; unknown activity counts as active."""
    rank = F.struct("score", F.coalesce("active", F.lit(True)).cast("int").alias("active"))
    given = candidates.where("value IS NOT NULL").withColumn("rank", rank)
    best = given.groupBy(*by).agg(F.max("rank").alias("best"))
    top = given.join(best, by).where("rank = best").groupBy(*by).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    ids = given.groupBy(*by).agg(F.transform(F.sort_array(F.collect_set(F.struct("rank", "evidence_id")), asc=False), lambda x: x["evidence_id"]).alias("evidence_ids"))
    same = F.col("low") == F.col("high")
    return top.join(ids, by).select(*by, F.when(same, "known").otherwise("conflict").alias("state"), F.when(same, F.col("low")).alias("value"), F.array_distinct("evidence_ids").alias("evidence_ids"))


#: Fixed values.
QUALITY_RANK = {"complete": 4, "short": 2, "snippet": 1, "template": 0, "empty": 0}


def select_description(candidates: DataFrame, by: str) -> DataFrame:
    """Candidates (by, quality, active, native, length, source, id) with their place and whether they are chosen. Templates and empty
    texts are never chosen. Unknown activity counts as active."""
    quality = F.element_at(F.create_map(*[F.lit(x) for kv in QUALITY_RANK.items() for x in kv]), F.col("quality"))
    order = [F.desc(quality), F.desc(F.coalesce("active", F.lit(True)).cast("int")), F.desc("native"), F.desc("length"), F.desc("source"), F.desc("id")]
    placed = candidates.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return placed.withColumn("selected", (F.col("place") == 1) & ~F.col("quality").isin("empty", "template"))


def order_locations(locations: DataFrame, by: str) -> DataFrame:
    """Distinct places of a job by their best evidence, and whether the best ones disagree on the country."""
    best = locations.groupBy(by, "place", "country").agg(F.max("score").alias("score"))
    w = Window.partitionBy(by)
    top = best.withColumn("top", F.max("score").over(w))
    return top.groupBy(by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("k"), "place"))), lambda x: x["place"]).alias("places"),
        (F.count_distinct(F.when(F.col("score") == F.col("top"), F.col("country"))) > 1).alias("country_conflict"),
    )


def fingerprint(inputs: DataFrame, by: str, metadata: list[str], description: str, versions: dict[str, str], sources: DataFrame | None = None, source_fields: list[str] | None = None) -> DataFrame:
    """Digests of metadata, description, source inputs and rule versions, and one of all. Times and run ids are left out by not being named.
    The digest of the sources (by, source_fields) does not depend on their order."""
    digest = lambda cols: F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    rules = F.sha2(F.lit("|".join(f"{k}={v}" for k, v in sorted(versions.items()))), 256)
    out = inputs.select(by, digest([F.col(c) for c in sorted(metadata)]).alias("metadata_hash"), F.sha2(F.coalesce(description, F.lit("")), 256).alias("text_hash"), rules.alias("version_hash"))
    parts = ["metadata_hash", "text_hash", "version_hash"]
    if sources is not None:
        each = sources.select(by, digest([F.col(c) for c in sorted(source_fields or [])]).alias("_d"))
        out = out.join(each.groupBy(by).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("_d")), "|"), 256).alias("sources_hash")), by, "left")
        out = out.withColumn("sources_hash", F.coalesce("sources_hash", F.sha2(F.lit(""), 256)))
        parts.insert(2, "sources_hash")
    return out.withColumn("input_hash", F.sha2(F.concat_ws("|", *parts), 256))


def layers_to_run(current: DataFrame, previous: DataFrame, by: str) -> DataFrame:
    """What has to be worked out again. An unchanged row runs nothing; text results are reused if text and rules are the same."""
    old = previous.select(by, *[F.col(c).alias(f"old_{c}") for c in ("metadata_hash", "text_hash", "version_hash", "input_hash")])
    j = current.join(old, by, "left")
    same = lambda c: F.col(c).eqNullSafe(F.col(f"old_{c}"))
    text = ~(same("text_hash") & same("version_hash"))
    native = ~(same("metadata_hash") & same("version_hash"))
    layers = F.when(same("input_hash"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(F.when(native, F.lit("native")), F.when(text, F.lit("text")), F.lit("selection"), F.lit("profile"))))
    return j.select(by, layers.alias("layers"))


def choose_offers(offers: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """R08, offers: (by, offers): the whole set of the best source of each job (highest score, then first name); sets of two sources are never mixed."""
    best = offers.groupBy(by).agg(F.max_by("source_name", F.struct("score", F.expr("-hash(source_name)"), "source_name")).alias("source_name"))
    return offers.join(best, [by, "source_name"]).groupBy(by).agg(F.array_distinct(F.sort_array(F.collect_list(F.struct(*fields)))).alias("offers"))


def assemble_profiles(facts: DataFrame, jobs: DataFrame, by: str, fields: list[str], offers: DataFrame | None = None, locations: DataFrame | None = None) -> DataFrame:
    """One struct for each job: a fact (state, value, evidence_ids) for each field, the chosen offers (by, offers) and the ordered places (by, places,
    country_conflict). A field without a fact is `not_mentioned` if the description is complete, else `insufficient_content`."""
    absent = F.when(F.col("quality") == "complete", "not_mentioned").otherwise("insufficient_content")
    if "evidence_ids" not in facts.columns:
        facts = facts.withColumn("evidence_ids", F.array().cast("array<string>"))
    one = lambda f: F.max_by(F.struct("state", "value", "evidence_ids"), F.when(F.col("field") == f, F.lit(1))).alias(f"_f_{f}")
    flat = facts.where(F.col("field").isin(*fields)).groupBy(by).agg(*[one(f) for f in fields])
    j = jobs.join(flat, by, "left")
    made = lambda f: F.struct(F.coalesce(F.col(f"_f_{f}.state"), absent).alias("state"), F.col(f"_f_{f}.value").alias("value"), F.coalesce(F.col(f"_f_{f}.evidence_ids"), F.array().cast("array<string>")).alias("evidence_ids")).alias(f)
    parts = [made(f) for f in fields]
    if offers is not None:
        j = j.join(offers.select(by, "offers"), by, "left")
        parts.append(F.col("offers"))
    if locations is not None:
        j = j.join(locations.select(by, "places", "country_conflict"), by, "left")
        parts += [F.col("places"), F.col("country_conflict")]
    return j.select(by, F.struct(*parts).alias("profile"))


def publish_versions(versions: DataFrame, new: DataFrame, by: str, deleted: DataFrame | None = None, merged: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(all versions, current pointers). A version that is there already is not added again. Jobs in `deleted` (by) lose their pointer and keep
    their history; keepers in `merged` (by) point to their newest version, marked stale until they are worked out again."""
    fresh = new.dropDuplicates([by, "input_hash"]).join(versions.select(by, "input_hash"), [by, "input_hash"], "left_anti")
    allv = versions.unionByName(fresh)
    newest = allv.groupBy(by).agg(F.max_by("input_hash", F.struct("created_at", "input_hash")).alias("input_hash"))
    if deleted is not None:
        newest = newest.join(deleted.select(by).distinct(), by, "left_anti")
    if merged is not None:
        newest = newest.join(merged.select(by).distinct().withColumn("_m", F.lit(True)), by, "left").withColumn("stale", F.coalesce("_m", F.lit(False))).drop("_m")
    return allv, newest


def check_profiles(facts: DataFrame, evidence: DataFrame, by: str, countries: DataFrame | None = None, ranges: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Violations: a known fact without value or evidence, another (but a conflict) with a value, evidence that does not exist or has one id for two
    contents, spans out of order, countries that are no ISO code (`countries`: country), and ranges (name to two columns of facts) upside down."""
    held = evidence.select("evidence_id").distinct().withColumn("_there", F.lit(True))
    known, conflict = F.col("state") == "known", F.col("state") == "conflict"
    blank = F.col("value").isNull() | (F.trim("value") == "")
    plain = facts.select(by, "field", F.when(known & blank, "known_without_value").when(known & (F.size("evidence_ids") == 0), "known_without_evidence").when(~known & ~conflict & F.col("value").isNotNull(), "value_without_knowledge").alias("problem")).where("problem IS NOT NULL")
    used = facts.select(by, "field", F.explode("evidence_ids").alias("evidence_id")).join(held, "evidence_id", "left").where("_there IS NULL").select(by, "field", F.lit("dangling_evidence").alias("problem")).distinct()
    spans = evidence.where("end < start").select(by, "field", F.lit("span_out_of_order").alias("problem")).distinct()
    twice = evidence.groupBy("evidence_id").agg(F.count("*").alias("_n"), F.min(by).alias(by), F.min("field").alias("field")).where("_n > 1").select(by, "field", F.lit("duplicate_evidence").alias("problem"))
    out = plain.unionByName(used).unionByName(spans).unionByName(twice)
    if countries is not None:
        odd = facts.where((F.col("field") == "country") & F.col("value").isNotNull()).join(countries.select(F.col("country").alias("value")).distinct(), "value", "left_anti")
        out = out.unionByName(odd.select(by, "field", F.lit("no_iso_country").alias("problem")))
    for name, (low, high) in (ranges or {}).items():
        out = out.unionByName(facts.where(F.col(high) < F.col(low)).select(by, "field", F.lit(f"{name}_out_of_order").alias("problem")))
    return out


def coverage_matrix(winners: DataFrame) -> DataFrame:
    """Winning evidence (field, kind) as a matrix of counts."""
    kinds = ["native", "parsed", "provider", "suggestion", "unknown", "conflict"]
    return winners.groupBy("field").pivot("kind", kinds).agg(F.count("field")).fillna(0, kinds)
