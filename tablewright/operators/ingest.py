"""One feed from landed records to the new state of companies, jobs, sources and the run ledger."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.text import exact_title_key, normalize_url
from tablewright.functions.values import native_id, region_evidence, url_identity
from tablewright.operators.lifecycle import canonical_activity
from tablewright.operators.linkage import UUID, agreed_identity, existing_source, resolve_company, resolve_ranked
from tablewright.operators.merging import FALLBACK_TITLE, SOURCE_PRIORITY, guarded_update, source_priority, upsert_snapshot
from tablewright.sources.landing import MORE, first_of, only_listed, project_canonical, route_invalid
from tablewright.storage import staged

FIELDS = ["company_id", "title", "description", "location_text", "remote_type", "employment_type", "salary_text", "canonical_url"]
KEPT_IF_NONE = ("description", "location_text", "employment_type", "salary_text", "canonical_url")


class State(NamedTuple):
    """companies (id, name, created_at), jobs (id, FIELDS, status, last_seen_at), sources (source_name, source_job_id, job_id, source_url, raw_payload,
    is_active, last_seen_at)."""

    companies: DataFrame
    jobs: DataFrame
    sources: DataFrame


class Ingested(NamedTuple):
    state: State
    rows: DataFrame  # each landed record: source_job_id, job_id, change (created, attached, updated, duplicate, skipped or rejected, with the reason) and the evidence of an attachment
    run: DataFrame  # the ledger's row


class Rules(NamedTuple):
    """How a feed is taken in. `shape` of its ids; `evidence`: kinds of evidence by rank, the kinds of one rank put together; `board`: (hosts, path) patterns
    of its own addresses, whose first group is the tenant and second the id; `hosts`: verified hosts; `home`: the country whose jobs count, with `markers` that name it in a label."""

    shape: str
    evidence: tuple[tuple[str, ...], ...]
    board: tuple[str, str] | None = None
    hosts: tuple[str, ...] = ()
    home: str | None = None
    markers: tuple[str, ...] = ("cesko", "czechia", "czech republic")


_BOARD = r"^/([A-Za-z0-9_-]+)/([A-Za-z0-9-]+)(?:/apply)?/?$"
#: What each feed attaches by, best first (J03 to J08), besides its own source rows.
RULES: dict[str, Rules] = {
    "smartrecruiters_direct": Rules("digits", (("url",),)),
    "greenhouse_direct": Rules("digits", (("native", "url"),), (r"^boards\.", _BOARD)),
    "workable_direct": Rules("site", (("url",), ("title",))),
    "ashby_direct": Rules("uuid", (("url",), ("uuid",), ("title",)), home="CZ"),
    "lever_direct": Rules("digits", (("identity",), ("url",), ("title",)), (r"^jobs\.", _BOARD), home="CZ"),
    "workday_direct": Rules("site", (("identity",), ("url",)), (r"^[a-z0-9-]+\.jobs\.", _BOARD)),
    "successfactors_direct": Rules("digits", (("hosts",), ("url",)), (r"", _BOARD)),
    "fantastic_jobs_apify": Rules("digits", (("url",),)),
    "jooble_direct": Rules("digits", (("url",),)),
}


def projected(batch: DataFrame, feed: str, rules: Rules | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows to take in, duplicates, left out with their `change`) of a batch (scope, body). Of the rows of one identity the first (by payload) counts."""
    rules = rules or RULES[feed]
    flag = MORE.get(feed, {}).get("listed")
    shown = first_of(F.col("raw_payload"), [flag]).try_cast("boolean") if flag else F.lit(None).cast("boolean")
    # Each way that a row can go reads them, so payloads are parsed once and written down.
    rows = staged(project_canonical(batch, feed).withColumns({"source_job_id": native_id([F.col("scope")], F.col("native_id"), rules.shape), "_listed": shown}), "projected")
    good, bad = route_invalid(rows, [(F.col("source_job_id").isNull(), "missing_identity"), (F.col("title") == FALLBACK_TITLE, "missing_title")])
    listed = only_listed(good, F.col("_listed"))
    left = [bad.select("source_job_id", F.concat(F.lit("rejected: "), "reject_reason").alias("change")), good.where("NOT coalesce(_listed, true)").select("source_job_id", F.lit("skipped: unlisted").alias("change"))]
    if rules.home:
        country = F.upper(F.nullif(F.trim("country"), F.lit("")))
        near = region_evidence(country, F.array().cast("array<string>"), F.col("location_text"), rules.home, list(rules.markers))
        left.append(listed.where(near.isNull()).select("source_job_id", F.lit("skipped: foreign").alias("change")))
        listed = listed.where(near.isNotNull())
    placed = listed.withColumn("_r", F.row_number().over(Window.partitionBy("source_job_id").orderBy("raw_payload"))).drop("_listed")
    return placed.where("_r = 1").drop("_r"), placed.where("_r > 1").drop("_r"), reduce(DataFrame.unionByName, left)


def title_key(company: Column, title: Column) -> Column:
    return F.when(company.isNotNull() & (company != ""), F.concat_ws(":", company, exact_title_key(title)))


def board_identity(url: Column, rules: Rules) -> Column:
    """Host's tenant and id of an address of the feed's own board, or null."""
    found = url_identity(url, rules.board[0], rules.board[1], "tenant", "id")
    return F.concat_ws(":", F.lower(found["tenant"]), found["id"])


def evidence_of_batch(rows: DataFrame, feed: str, rules: Rules | None = None) -> DataFrame:
    """(probe, rank, kind, key): what a row may be found by. A title that stands twice within its company counts for nothing."""
    rules = rules or RULES[feed]
    keys = {
        "url": normalize_url(F.col("url")),
        "native": F.col("native_id"),
        "identity": F.concat_ws(":", F.lower("scope"), F.col("native_id")),
        "uuid": F.nullif(F.regexp_extract(F.lower("native_id"), UUID, 1), F.lit("")),
        "hosts": F.col("native_id"),
        "title": title_key(F.col("company_id"), F.col("title")),
    }
    found = F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), keys[kind].alias("key")) for rank, kinds in enumerate(rules.evidence) for kind in kinds])
    each = rows.select(F.col("source_job_id").alias("probe"), F.explode(found).alias("e")).select("probe", "e.*").where("key <> ''")
    lone = each.where("kind = 'title'").groupBy("rank", "kind", "key").agg(F.min("probe").alias("probe"), F.count("*").alias("n")).where("n = 1").select("probe", "rank", "kind", "key")
    return each.where("kind <> 'title'").unionByName(lone)


def evidence_of_state(state: State, feed: str, rules: Rules | None = None) -> DataFrame:
    """(kind, key, target, taken): what the jobs may be found by. `taken`: the job has a row of this feed already."""
    rules = rules or RULES[feed]
    kinds = {kind for rank in rules.evidence for kind in rank}
    others = state.sources.where(F.col("source_name") != feed)
    second = F.col("apply_url") if "apply_url" in state.sources.columns else F.lit(None).cast("string")
    urls = F.array_compact(F.array("source_url", second))
    parts = []
    of = lambda kind, key, rows=others: parts.append(rows.select(F.lit(kind).alias("kind"), key.alias("key"), F.col("job_id").alias("target"), F.lit(False).alias("taken")).where("key <> ''"))
    if "url" in kinds:
        of("url", normalize_url(F.col("url")), others.select("job_id", F.explode(urls).alias("url")))
        of("url", normalize_url(F.col("canonical_url")), state.jobs.select(F.col("id").alias("job_id"), "canonical_url"))
    if "native" in kinds:
        of("native", F.element_at(F.split(board_identity(F.col("source_url"), rules), ":"), -1))
    if "identity" in kinds:  # addresses that contradict one another say nothing (J06)
        of("identity", agreed_identity(F.transform(urls, lambda u: board_identity(u, rules))))
    if "uuid" in kinds:
        of("uuid", F.regexp_extract(F.lower("source_url"), UUID, 1))
    if "hosts" in kinds:  # every address must lie on a verified host and state one id (J07)
        at = F.transform(urls, lambda u: url_identity(u, rules.board[0], rules.board[1], "tenant", "id"))
        good = (F.size(at) > 0) & F.forall(at, lambda i: F.coalesce(i["host"].isin(*rules.hosts), F.lit(False)) & (i["id"] == at[0]["id"]))
        of("hosts", F.when(good, at[0]["id"]))
    if "title" in kinds:
        own = state.sources.where(F.col("source_name") == feed).select(F.col("job_id").alias("id"), F.lit(True).alias("own")).distinct()
        titled = state.jobs.select("id", title_key(F.col("company_id"), F.col("title")).alias("key")).where("key <> ''")
        parts.append(titled.join(own, "id", "left").select(F.lit("title").alias("kind"), "key", F.col("id").alias("target"), F.coalesce("own", F.lit(False)).alias("taken")))
    return reduce(DataFrame.unionByName, parts)


def ingest_feed(batch: DataFrame, state: State, feed: str, now: Column, run_id: str, rules: Rules | None = None, parts: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> Ingested:
    """Projects the batch (scope, body), rejects rows without identity or title, leaves out unlisted and foreign ones, resolves companies, finds each row's job by its own source,
    then by the best evidence that names exactly one job, else makes one, updates jobs under the priority guard, and writes sources, activity and the run's
    counters. New ids are digests of natural keys, so a rerun gives the same state. `parts`: the batch as `projected`, if that is done already."""
    rules = rules or RULES[feed]
    first, again, left = parts or projected(batch, feed, rules)
    named, new_companies = resolve_company(first, "company", state.companies)
    named = staged(named, "named")
    found = existing_source(named, state.sources.select("source_name", "source_job_id", F.col("job_id").alias("own")), ["source_name", "source_job_id"], "own")
    linked = resolve_ranked(evidence_of_batch(named, feed, rules), evidence_of_state(state, feed, rules))
    linked = found.join(linked.withColumnRenamed("probe", "source_job_id"), "source_job_id", "left")
    job = F.coalesce("own", "target", F.sha2(F.concat_ws(":", "source_name", "source_job_id"), 256))
    change = F.when(F.col("own").isNotNull(), "updated").when(F.col("target").isNotNull(), "attached").otherwise("created")
    # Every table of the new state reads these rows, so they are written down.
    taken = staged(linked.withColumns({"change": change, "job_id": job, "canonical_url": F.col("url"), "evidence": F.when(F.col("own").isNull(), F.col("kind"))}).drop("target", "own"), "taken")

    new_jobs = taken.where("change = 'created'").select(F.col("job_id").alias("id"), *FIELDS, F.lit("active").alias("status"), now.alias("last_seen_at"))
    # Two rows can meet in one job; the one of the smaller identity speaks for it.
    meets = taken.where("change <> 'created'").groupBy(F.col("job_id").alias("id")).agg(F.min_by(F.struct(*FIELDS), "source_job_id").alias("row"))
    incoming = meets.select("id", F.lit(SOURCE_PRIORITY.get(feed, 0)).alias("priority"), "row.*")
    backing = state.sources.select(F.col("job_id").alias("id"), source_priority(F.col("source_name")).alias("priority"))
    updated = guarded_update(state.jobs, incoming, backing, "id", FIELDS, now, KEPT_IF_NONE)
    jobs = updated.select("id", *FIELDS, "status", "last_seen_at").unionByName(new_jobs)

    held = taken.select("source_name", "source_job_id", "job_id", F.col("url").alias("source_url"), "raw_payload", F.lit(True).alias("is_active"), now.alias("last_seen_at"))
    sources = upsert_snapshot(state.sources.select(*held.columns), held, ["source_name", "source_job_id"]).drop("change")
    jobs = canonical_activity(jobs, sources.withColumn("id", F.col("job_id")), "id", [feed])
    companies = state.companies.select("id", "name", "created_at").unionByName(new_companies.select("id", "name", now.alias("created_at")))

    none = F.lit(None).cast("string")
    log = taken.select("source_job_id", "job_id", "change", "evidence")
    log = log.unionByName(again.select("source_job_id", none.alias("job_id"), F.lit("duplicate").alias("change"), none.alias("evidence")))
    log = log.unionByName(left.select("source_job_id", none.alias("job_id"), "change", none.alias("evidence")))
    log = staged(log, "log")
    count = lambda *names: F.count_if(F.col("change").isin(*names))
    failed, skipped = F.count_if(F.startswith("change", F.lit("rejected"))), F.count_if(F.startswith("change", F.lit("skipped")))
    run = log.agg(F.count("*").alias("records_fetched"), count("created").alias("records_created"), count("attached").alias("records_attached"), count("updated").alias("records_updated"), skipped.alias("records_skipped"), failed.alias("records_failed"))
    run = run.select(F.lit(run_id).alias("id"), F.lit(feed).alias("source_name"), F.lit("success").alias("status"), now.alias("started_at"), "*")
    return Ingested(State(companies, jobs, sources), log, run)
