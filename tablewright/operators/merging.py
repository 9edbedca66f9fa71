"""Priority-guarded updates, snapshots and set-based merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.values import field_is_empty

#: How much a feed is trusted; unknown feeds count 0.
SOURCE_PRIORITY = {
    "smartrecruiters_direct": 300,
    "greenhouse_direct": 300,
    "workable_direct": 300,
    "ashby_direct": 300,
    "lever_direct": 300,
    "workday_direct": 300,
    "successfactors_direct": 300,
    "fantastic_jobs_apify": 200,
    "jooble_direct": 100,
}
FALLBACK_TITLE = "Unknown position"


def source_priority(c: Column, priorities: dict[str, int] = SOURCE_PRIORITY) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in priorities.items() for x in kv]), c), F.lit(0))


def guarded_update(current: DataFrame, incoming: DataFrame, backing: DataFrame, key: str, fields: list[str], now: Column, preserve_if_none: tuple[str, ...] = ()) -> DataFrame:
    """`incoming` (key, priority, fields) into `current` (key, fields). `backing`: (key, priority) of all attached sources.

    An incoming row of the highest priority or more overwrites, except nulls of fields to be preserved; a lower one only fills
    empty fields with something, never with the fallback title. last_seen_at always advances."""
    top = backing.groupBy(key).agg(F.max("priority").alias("_top"))
    new = incoming.select(key, F.col("priority").alias("_priority"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = current.join(new, key, "left").join(top, key, "left")
    wins = F.col("_priority") >= F.coalesce("_top", F.lit(0))
    kinds = dict(current.dtypes)

    def field(f: str) -> Column:
        own, other = F.col(f), F.col(f"_{f}")
        takes = other.isNotNull() if f in preserve_if_none else F.lit(True)
        fills = field_is_empty(f, own, kinds[f]) & ~field_is_empty(f, other, kinds[f])
        if f == "title":
            fills = fills & (other != FALLBACK_TITLE)
        return F.when(F.col("_priority").isNull(), own).when(wins, F.when(takes, other).otherwise(own)).when(fills, other).otherwise(own).alias(f)

    rest = [c for c in current.columns if c not in (*fields, "last_seen_at")]
    seen = F.when(F.col("_priority").isNotNull(), now).otherwise(F.col("last_seen_at") if "last_seen_at" in current.columns else F.lit(None).cast("timestamp"))
    return joined.select(*rest, *[field(f) for f in fields], seen.alias("last_seen_at"))


def upsert_snapshot(snapshot: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The new snapshot, with `change` = created, updated or kept. A full join on the key; the batch's values win where given."""
    values = [c for c in snapshot.columns if c not in keys]
    old = snapshot.withColumn("_old", F.lit(True))
    new = batch.select(*keys, *[F.col(c).alias(f"_{c}") for c in values]).withColumn("_new", F.lit(True))
    change = F.when(F.col("_old").isNull(), "created").when(F.col("_new").isNull(), "kept").otherwise("updated")
    return old.join(new, keys, "full").select(*keys, *[F.coalesce(f"_{c}", c).alias(c) for c in values], change.alias("change"))


def append_new(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose key is not there yet; of equal keys within the batch one. The result is what a sink appends."""
    return new.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti")


def merge_plan(candidates: DataFrame, priorities: DataFrame) -> DataFrame:
    """R03, first half: keeper and removed job of each candidate (a, b), by the higher priority; ties are rejected.

    A job that is kept or removed more than once would make the result depend on the order, so its candidates are rejected too."""
    side = lambda s: priorities.select(F.col("id").alias(s), F.col("priority").alias(f"p{s}"))
    both = candidates.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    ends = both.select(F.col("a").alias("id")).unionByName(both.select(F.col("b").alias("id"))).groupBy("id").count()
    used = lambda s: ends.select(F.col("id").alias(s), F.col("count").alias(f"n{s}"))
    out = both.join(used("a"), "a").join(used("b"), "b")
    reason = F.when(F.col("pa") == F.col("pb"), "equal_priority").when((F.col("na") > 1) | (F.col("nb") > 1), "shared_endpoint")
    keep_a = F.col("pa") > F.col("pb")
    return out.select(F.when(keep_a, F.col("a")).otherwise(F.col("b")).alias("kept"), F.when(keep_a, F.col("b")).otherwise(F.col("a")).alias("removed"), reason.alias("rejected"))


def apply_merges(plan: DataFrame, jobs: DataFrame, sources: DataFrame, fill: list[str], earliest: list[str], latest: list[str], dry_run: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R03, second half: (jobs, sources, history). `jobs`: id and fields; `sources`: id, job_id. With dry_run jobs and sources stay."""
    good = plan.where("rejected IS NULL").select("kept", "removed")
    old = jobs.select(F.struct(*jobs.columns).alias("_removed"), F.col("id").alias("removed"))
    pairs = good.join(old, "removed").withColumnRenamed("kept", "id")
    joined = jobs.join(pairs, "id", "left")
    kinds = dict(jobs.dtypes)
    other = lambda c: F.col("_removed")[c]
    merged = {c: F.when(field_is_empty(c, F.col(c), kinds[c]), F.coalesce(other(c), F.col(c))).otherwise(F.col(c)) for c in fill}
    merged |= {c: F.least(F.col(c), other(c)) for c in earliest} | {c: F.greatest(F.col(c), other(c)) for c in latest}
    history = joined.where("_removed IS NOT NULL").select(F.col("id").alias("kept_job_id"), F.col("removed").alias("removed_job_id"), F.struct(*jobs.columns).alias("kept_before"), F.col("_removed").alias("removed_before"))
    if dry_run:
        return jobs, sources, history
    gone = good.select(F.col("removed").alias("id"))
    new_jobs = joined.select(*[merged.get(c, F.col(c)).alias(c) for c in jobs.columns]).join(gone, "id", "left_anti")
    moved = sources.join(good.withColumnRenamed("removed", "job_id"), "job_id", "left")
    new_sources = moved.select(*[F.coalesce("kept", "job_id").alias("job_id") if c == "job_id" else F.col(c) for c in sources.columns])
    return new_jobs, new_sources, history
