"""Freshness classes, source families, scope health and run outcomes. `now` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
WINDOWS = (24, 72, 168, 336, 720)


def hours(n: int) -> Column:
    return F.make_interval(hours=F.lit(n))


def composition(sources: DataFrame, job: str, direct: list[str], a: str, b: str) -> DataFrame:
    """What kinds of sources back a job. `a` and `b` are the two aggregators."""
    is_direct = F.col("source_name").isin(*direct)
    flags = sources.groupBy(job).agg(F.bool_or(is_direct).alias("d"), F.bool_or(~is_direct).alias("o"), F.bool_or(F.col("source_name") == a).alias("a"), F.bool_or(F.col("source_name") == b).alias("b"), F.bool_or(~is_direct & ~F.col("source_name").isin(a, b)).alias("x"))
    name = (
        F.when(F.col("d") & F.col("o"), "direct_plus_aggregator").when(F.col("d"), "direct_only").when(F.col("x"), "other").when(F.col("a") & F.col("b"), "both_aggregators").when(F.col("a"), "a_only").when(F.col("b"), "b_only").otherwise("other")
    )
    return flags.select(job, name.alias("composition"))


def exact_median(df: DataFrame, by: str, value: Column, width: int) -> DataFrame:
    """(by, median) of a whole number, exact, without all values of a group in one task: values are counted in bins of `width`, and only those of the
    bins that hold the middle are looked at, once for each distinct value."""
    rows = df.select(by, value.cast("long").alias("_v")).where("_v IS NOT NULL").withColumn("_bin", F.floor(F.col("_v") / width))
    w = Window.partitionBy(by)
    bins = rows.groupBy(by, "_bin").agg(F.count("*").alias("_k")).withColumns({"_n": F.sum("_k").over(w), "_upto": F.sum("_k").over(w.orderBy("_bin"))})
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)  # ranks of the middle, from 0
    middle = bins.where((F.col("_upto") > low) & (F.col("_upto") - F.col("_k") <= high)).select(by, "_bin", "_n", (F.col("_upto") - F.col("_k")).alias("_ahead"))
    inside = rows.join(middle, [by, "_bin"]).groupBy(by, "_v").agg(F.count("*").alias("_k"), F.min("_ahead").alias("_ahead"), F.min("_n").alias("_n"))
    upto = F.min("_ahead").over(w) + F.sum("_k").over(w.orderBy("_v"))
    placed = inside.withColumn("_upto", upto)
    at = lambda rank: F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_k") <= rank), F.col("_v")))
    return placed.groupBy(by).agg(((at(low) + at(high)) / 2).alias("median"))


def family_stats(sources: DataFrame, job: str, now: Column) -> DataFrame:
    """One row for each source: totals, distinct jobs, newest and oldest evidence, exact median age of active rows in days."""
    active = F.coalesce("is_active", F.lit(False))
    stats = sources.groupBy("source_name").agg(
        F.count("*").alias("total"), F.count_if(active).alias("active"), F.count_if(~active).alias("inactive"), F.count_distinct(job).alias("jobs"),
        F.max("last_seen_at").alias("newest_seen"), F.min(F.when(active, F.col("last_seen_at"))).alias("oldest_active"),
    )
    age = F.unix_micros(now) - F.unix_micros("last_seen_at")
    median = exact_median(sources.where(active), "source_name", age, 60_000_000)
    return stats.join(median, "source_name", "left").withColumn("median_age_days", F.round(F.col("median") / 86400e6, 3)).drop("median")


def age_matrix(jobs: DataFrame, sources: DataFrame, job: str, now: Column, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Active jobs by composition, and how many were not seen within each window; a total row (null)."""
    last = sources.where("is_active").groupBy(job).agg(F.max("last_seen_at").alias("last"))
    joined = jobs.where("status = 'active'").join(last, job, "left")
    late = lambda h: F.count_if(F.col("last").isNull() | (F.col("last") < now - hours(h))).alias(f"not_seen_{h}h")
    return joined.rollup("composition").agg(F.count("*").alias("active_jobs"), *[late(h) for h in windows])


def latest_runs(runs: DataFrame, n: int = 1) -> DataFrame:
    """The latest n runs of each source."""
    w = Window.partitionBy("source_name").orderBy(F.desc("started_at"), F.desc("id"))
    return runs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def failure_streak(runs: DataFrame, scope: str) -> DataFrame:
    """Failures since the last success, counted back from the newest run. With aggregates only: a scope's history may be long."""
    last_ok = runs.groupBy(scope).agg(F.max(F.when(F.col("ok"), F.struct("started_at", "id"))).alias("last_ok"), F.max_by("error", F.when(~F.col("ok"), F.struct("started_at", "id"))).alias("last_error"))
    since = F.col("last_ok").isNull() | (F.struct("started_at", "id") > F.col("last_ok"))
    return runs.join(last_ok, scope).groupBy(scope).agg(F.count_if(~F.col("ok") & since).alias("streak"), F.max("last_ok.started_at").alias("last_success"), F.max("last_error").alias("last_error"))


def scope_history(runs: DataFrame, scope: str, event: str, last: int = 5) -> DataFrame:
    """W03 of each scope, with what its last runs were, newest first."""
    recent = latest_runs(runs.withColumn("source_name", F.col(scope)), last).groupBy(scope).agg(F.sort_array(F.collect_list(F.struct("started_at", "id", event)), asc=False).alias("_r"))
    return failure_streak(runs, scope).join(recent.select(scope, F.transform("_r", lambda x: x[event]).alias("recent")), scope)


def in_force(now: Column) -> Column:
    return (F.col("reviewed_at") <= now) & (now < F.col("review_expires_at"))


def with_valid_review(df: DataFrame, policies: DataFrame, on: list[str], now: Column) -> DataFrame:
    """The policy of a row's scope if its review is in force. One row for each scope, so the join is left to the optimiser."""
    return df.join(policies.where(in_force(now)), on, "left")


def proven(sources: DataFrame, runs: DataFrame, scopes: DataFrame, state: str) -> DataFrame:
    """Sources whose run succeeded for the same source, with a complete scope of their own."""
    life = sources.where((F.col("lifecycle_state") == state) & F.col("inventory_complete"))
    good_runs = runs.where("status = 'success' AND NOT bounded").select(F.col("id").alias("run_id"), F.col("source_name"))
    good_scopes = scopes.where("complete AND successful").select("run_id", "scope").distinct()
    return life.join(good_runs, ["run_id", "source_name"], "left_semi").join(good_scopes, ["run_id", "scope"], "left_semi")


def complete_runs(runs: DataFrame, scopes: DataFrame) -> DataFrame:
    """Unbounded runs that asked for scopes, got all of them and completed each."""
    seen = scopes.groupBy("run_id").agg(F.count("*").alias("n"), F.every(F.col("complete") & F.col("successful")).alias("all_complete"))
    joined = runs.join(seen.withColumnRenamed("run_id", "id"), "id", "left")
    whole = (F.col("status") == "success") & ~F.col("bounded") & (F.col("requested") > 0) & (F.coalesce("n", F.lit(0)) == F.col("requested")) & F.coalesce("all_complete", F.lit(False))
    return joined.select("id", "source_name", whole.alias("full_complete"))


def freshness_class(jobs: DataFrame, sources: DataFrame, job: str, now: Column, native_hours: int = 72) -> DataFrame:
    """Class and reasons of each job. Sources: is_direct, is_active, proved_absent, proved_observed, suspended, last_seen_at, last_verified_at."""
    cut = now - hours(native_hours)
    fresh = lambda c: F.coalesce(F.col(c) >= cut, F.lit(False))
    act = F.col("is_direct") & F.col("is_active")
    gone = F.col("is_direct") & ~F.col("is_active") & F.col("proved_absent")
    verified = act & ~F.col("suspended") & F.col("proved_observed") & fresh("last_seen_at") & fresh("last_verified_at")
    some = lambda c, name: F.coalesce(F.bool_or(c), F.lit(False)).alias(name)
    facts = sources.groupBy(job).agg(
        F.count("*").alias("n"), F.count_if(gone).alias("n_gone"), some(F.col("is_direct"), "direct"), some(act, "active"), some(~F.col("is_direct"), "provider"), some(act & F.col("suspended"), "suspended"),
        some(verified, "verified"), some(act & fresh("last_verified_at"), "recent"), some(act & F.col("proved_observed"), "proved"), some(F.col("is_active"), "any_active"),
    )
    j = jobs.join(facts, job, "left")
    bare = F.col("n").isNull()
    closed = ~bare & (F.col("n_gone") == F.col("n")) & F.col("status").isin("inactive", "expired")
    live = ~bare & F.col("verified") & (F.col("status") == "active")
    expired = F.coalesce(F.col("expires_at") < now, F.lit(False))
    state = F.when(closed, "CONFIRMED_INACTIVE").when(live, "VERIFIED_ACTIVE").otherwise("NEEDS_VERIFICATION")
    say = lambda cond, text: F.when(cond, F.lit(text))
    open_ = F.array_compact(F.array(
        say((F.col("n_gone") > 0) & F.col("provider") & ~F.col("active"), "direct_withdrawn_but_aggregator_present"),
        say(F.col("suspended"), "reviewed_native_scope_coverage_gap"),
        say(~F.col("direct"), "discovery_only"),
        say(F.col("active") & ~F.col("recent"), "direct_evidence_stale"),
        say(F.col("active") & ~F.col("proved"), "authoritative_completeness_unproven"),
        say(expired, "expired_timestamp_unconfirmed"),
        say((F.col("status") != "active") & F.col("any_active"), "canonical_source_activity_conflict"),
        F.lit("no_recent_native_verification"),
    ))
    reasons = (
        F.when(bare, F.array(F.lit("no_sources")))
        .when(closed, F.array(F.lit("all_authoritative_sources_confirmed_absent")))
        .when(live, F.array_compact(F.array(F.lit("recent_complete_native_scope_evidence"), say(expired, "expiry_overridden_by_verified_native"))))
        .otherwise(open_)
    )
    return j.select(job, "status", state.alias("freshness"), reasons.alias("reasons"))


def status_counts(df: DataFrame, column: str) -> DataFrame:
    """G10."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def reason_counts(df: DataFrame) -> DataFrame:
    """Reasons overlap, so they may sum to more than the jobs."""
    return df.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


#: Review states that keep a scope from acting, and counters of a record-quality ledger that call for an alert.
QUARANTINE = ("KNOWN_UNAVAILABLE", "NEEDS_REVIEW")
ALERT_COUNTERS = ("identity_unknown", "unclassified", "required_failures", "fetch_failures")


def classify_scopes(rows: DataFrame, policies: DataFrame, now: Column) -> DataFrame:
    """State, coverage, eligibility and alerts of each scope.

    Rows: scope, source_name, ok (acquisition), successful and complete (of the inventory; null where there is no evidence), transient, error, signature
    (of the coverage), the counters of ALERT_COUNTERS, systemic, and manifest_complete (null without a manifest). Policies: scope,
    review_state, reviewed_at, review_expires_at, expected_error, expected_signature. A review never grants eligibility: it only explains a gap that
    looks exactly as it was reviewed, or withholds eligibility, even after it has run out."""
    j = rows.join(policies.withColumn("_valid", in_force(now)), "scope", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    reviewed, valid = F.col("review_state").isNotNull(), yes(F.col("_valid"))
    ok, complete = F.col("ok"), F.col("ok") & yes(F.col("successful")) & yes(F.col("complete"))
    matched = valid & F.when(F.col("expected_error").isNotNull(), yes(F.col("error") == F.col("expected_error"))).otherwise(yes(F.col("signature") == F.col("expected_signature")))
    counters = [F.coalesce(c, F.lit(0)) > 0 for c in ALERT_COUNTERS]
    quality = yes(F.col("systemic")) | counters[0] | counters[1] | counters[2] | counters[3]
    blocked = F.when(F.col("manifest_complete").isNotNull(), ~F.col("manifest_complete") | yes(F.col("systemic"))).otherwise(quality)
    quarantined = yes(F.col("review_state").isin(*QUARANTINE))
    contradicted = complete & reviewed & (F.col("review_state") != "HEALTHY")
    unproved = ok & (F.col("successful").isNull() | F.col("complete").isNull())
    coverage = (
        F.when(complete & quality & blocked, "INCOMPLETE")
        .when(unproved, "UNKNOWN")
        .when(ok & ~yes(F.col("successful")), "INCOMPLETE")
        .when(contradicted, "INCOMPLETE")
        .when(complete, "AUTHORITATIVE_COMPLETE")
        .when(matched, F.when(ok, "NON_AUTHORITATIVE_EXPECTED").otherwise("UNAVAILABLE"))
        .otherwise(F.when(ok, "INCOMPLETE").otherwise("UNAVAILABLE"))
    )
    state = F.when(quarantined | matched, F.col("review_state")).when(ok, "HEALTHY").when(yes(F.col("transient")), "TRANSIENT_FAILURE").otherwise("NEEDS_REVIEW")
    say = lambda cond, text: F.when(cond, F.lit(text))
    alerts = F.array_compact(F.array(
        say(reviewed & ~valid, "review_expired_or_not_yet_effective"),
        say(valid & F.col("expected_error").isNotNull() & ok, "reviewed_exception_changed_behavior_requires_review"),
        say(contradicted, "reviewed_non_authoritative_scope_claimed_complete"),
        say(~complete & ~matched & ok, "unexpected_coverage_gap"),
        say(~complete & ~matched & ~ok, "unexpected_acquisition_failure"),
        say(unproved, "missing_lifecycle_scope_evidence"),
        say(ok & ~unproved & ~F.col("successful"), "acquisition_inventory_status_mismatch"),
        say(quality, "record_quality_requires_review"),
        say(complete & (counters[0] | counters[1]), "identity_coverage_requires_downgrade"),
        say(yes(F.col("systemic")), "systemic_record_failure"),
    ))
    out = j.select("scope", "source_name", state.alias("state"), coverage.alias("coverage"), (complete & ~blocked & ~quarantined).alias("eligible"), complete.alias("inventory_complete"), alerts.alias("alerts"), (matched & ~complete).alias("_gap"))
    return out.withColumn("known_gap", F.col("_gap") & F.col("coverage").isin("NON_AUTHORITATIVE_EXPECTED", "UNAVAILABLE")).drop("_gap")


def evaluate_source(classified: DataFrame, runs: DataFrame) -> DataFrame:
    """The outcome of each source's run (source_name, status, requested) from its scopes, with totals. A source is not judged a success if scope rows
    are missing or repeated, any scope has an alert, or a complete inventory is not eligible."""
    odd = (F.size("alerts") > 0) | (F.col("inventory_complete") & ~F.col("eligible"))
    seen = classified.groupBy("source_name").agg(F.count("*").alias("scopes"), F.count_distinct("scope").alias("distinct"), F.count_if("eligible").alias("eligible"), F.count_if("known_gap").alias("gaps"), F.count_if(F.col("state") == "NEEDS_REVIEW").alias("to_review"), F.count_if(odd).alias("alerted"))
    j = runs.select("source_name", "status", "requested").join(seen, "source_name", "left").fillna(0, ["scopes", "distinct", "eligible", "gaps", "to_review", "alerted"])
    accounted = (F.col("scopes") == F.col("requested")) & (F.col("distinct") == F.col("scopes"))
    unexpected = ~accounted | (F.col("alerted") > 0)
    outcome = (
        F.when((F.col("scopes") == 0) | ((F.col("status") == "failed") & ~((F.col("gaps") == F.col("scopes")) & ~unexpected)), "FAILED")
        .when(unexpected, "PARTIAL")
        .when(F.col("gaps") > 0, "SUCCESS_WITH_KNOWN_GAPS")
        .otherwise("SUCCESS")
    )
    return j.select("source_name", "scopes", "eligible", "gaps", "to_review", "alerted", accounted.alias("accounted"), outcome.alias("outcome"))


def backlog_review(found: DataFrame, policies: DataFrame, now: Column) -> DataFrame:
    """Telemetry that equals a valid review in every field."""
    valid = policies.where(in_force(now)).select("scope", "native_total", F.lit(True).alias("reviewed")).distinct()
    return found.join(valid, ["scope", "native_total"], "left").withColumn("reviewed", F.coalesce("reviewed", F.lit(False)))


def probe_decisions(policies: DataFrame, probes: DataFrame, scope: str, now: Column) -> DataFrame:
    """Whether a reviewed scope is to be probed again, when next, and whether its review runs out."""
    last = probes.groupBy(scope).agg(F.max("probed_at").alias("last_probe"))
    j = policies.join(last, scope, "left")
    nxt = F.when(F.col("last_probe").isNotNull(), F.col("last_probe") + F.make_interval(hours=F.col("recheck_hours")))
    return j.select(scope, F.coalesce(nxt <= now, F.lit(True)).alias("due"), nxt.alias("next_probe_at"), (F.col("review_expires_at") < now).alias("review_expired"))


def accepted_gaps(health: DataFrame, policies: DataFrame, scope: str, now: Column, within: int = 72) -> DataFrame:
    """Scopes that failed but are reviewed, currently so, checked within the window and without effects."""
    valid = policies.where(in_force(now)).select(scope).distinct()
    quiet = (F.col("checked_at") >= now - hours(within)) & (F.col("deactivated") == 0) & (F.col("reactivated") == 0) & ~F.col("ok")
    return health.where(quiet).join(valid, scope, "left_semi")


def check_outcomes(results: DataFrame, scopes: DataFrame, on: list[str]) -> DataFrame:
    """H10, first half: (on, problem) of results that contradict themselves or their scopes (on, scope, successful, complete, deactivated)."""
    seen = scopes.groupBy(*on).agg(
        F.count("*").alias("_rows"), F.count_distinct("scope").alias("_distinct"), F.sum("deactivated").alias("_deactivated"),
        F.bool_or(F.col("successful").isNull() | F.col("complete").isNull()).alias("_void"), F.bool_or((F.col("complete") & ~F.col("successful")) | ((F.col("deactivated") > 0) & ~F.col("complete"))).alias("_unsafe"),
    )
    j = results.join(seen, on, "left").fillna(0, ["_rows", "_distinct", "_deactivated"]).fillna(False, ["_void", "_unsafe"])
    problem = (
        F.when(~F.coalesce(F.col("status").isin("success", "failed"), F.lit(False)) | F.col("run_id").isNull(), "malformed_outcome")
        .when(F.least("requested", "fetched", "failed_records", "deactivated") < 0, "invalid_counter")
        .when((F.col("_rows") > F.col("requested")) | F.col("_void"), "invalid_scope_diagnostics")
        .when(F.col("_unsafe"), "unsafe_lifecycle_outcome")
        .when(F.col("_distinct") < F.col("_rows"), "duplicate_scope_diagnostics")
        .when(F.col("deactivated") != F.col("_deactivated"), "aggregate_does_not_match_scopes")
    )
    return j.select(*on, problem.alias("problem")).where("problem IS NOT NULL")


def normalize_outcome(results: DataFrame, scopes: DataFrame, baseline: DataFrame, on: list[str], collapse_ratio: float = 0.2) -> DataFrame:
    """(on, observed, gaps, volume, anomalies, status) of results (on, run_id, status, requested, fetched, failed_records, deactivated, gaps). Results with a
    problem are left out. A baseline (on, observed, gaps) is comparable if it was taken with the same reviewed gaps."""
    good = results.join(check_outcomes(results, scopes, on), on, "left_anti")
    seen = scopes.groupBy(*on).agg(F.count_if("successful").alias("successful"), F.count_if("complete").alias("complete"))
    j = good.join(seen, on, "left").fillna(0, ["successful", "complete"]).join(baseline.select(*on, F.col("observed").alias("_base"), F.col("gaps").alias("_gaps")), on, "left")
    n, gaps = F.col("requested"), F.col("gaps")
    same = F.coalesce(F.col("_gaps") == gaps, F.lit(False))
    comparable = same & (F.col("_base") > 0)
    say = lambda cond, text: F.when(cond, F.lit(text))
    anomalies = F.array_compact(F.array(
        say(n == 0, "no_scopes_requested"),
        say((F.col("complete") == 0) & (n != gaps), "no_authoritative_complete_scopes"),
        say(comparable & (F.col("fetched") == 0), "previously_nonempty_source_now_zero"),
        say(comparable & (F.col("fetched") > 0) & (F.col("fetched") < F.col("_base") * collapse_ratio), "unexpected_result_collapse"),
    ))
    volume = F.when(F.col("_base").isNull(), "unavailable").when(~same, "not_comparable_coverage_changed").when(comparable, "comparable").otherwise("unavailable")
    status = (
        F.when((F.col("status") == "failed") | ((n > 0) & (F.col("successful") == 0) & (n != gaps)), "FAILED")
        .when((F.col("complete") + gaps != n) | (F.col("failed_records") > 0) | (F.size("anomalies") > 0), "PARTIAL")
        .when(gaps > 0, "SUCCESS_WITH_KNOWN_GAPS")
        .otherwise("SUCCESS")
    )
    return j.withColumns({"anomalies": anomalies, "volume": volume}).select(*on, F.col("fetched").alias("observed"), "gaps", "volume", "anomalies", status.alias("status"))


def baseline_from_runs(runs: DataFrame, on: list[str]) -> DataFrame:
    """The latest healthy run with the same request."""
    best = runs.where("ok AND observed > 0").groupBy(*on).agg(F.max_by(F.struct("observed", "gaps"), F.struct("started_at", "id")).alias("_b"))
    return best.select(*on, "_b.observed", "_b.gaps")


def next_baseline(previous: DataFrame, results: DataFrame, on: list[str]) -> DataFrame:
    """Healthy results replace their baseline; a failure keeps the old one."""
    healthy = results.where("status IN ('SUCCESS', 'SUCCESS_WITH_KNOWN_GAPS')").select(*on, "observed", "gaps")
    return healthy.unionByName(previous.select(*on, "observed", "gaps").join(healthy.select(*on), on, "left_anti"))


def group_status(outcomes: DataFrame, group: str) -> DataFrame:
    """H12."""
    good = F.col("status").isin("SUCCESS", "SUCCESS_WITH_KNOWN_GAPS")
    status = F.when(F.every(F.col("status") == "SUCCESS"), "SUCCESS").when(F.every(good), "SUCCESS_WITH_KNOWN_GAPS").when(F.every(F.col("status") == "FAILED"), "FAILED").otherwise("PARTIAL")
    return outcomes.groupBy(group).agg(status.alias("group_status"))


def direct_verification(runs: DataFrame, scopes: DataFrame, names: list[str], heavy: list[str]) -> DataFrame:
    """For each direct source its latest complete unbounded run, and the latest run in which some scopes were verified completely, with how many. Runs (id, source_name, status,
    bounded, requested, started_at, finished_at); scopes (run_id, scope, complete, successful). A heavy source's bounded run verifies nothing. Sources without runs are listed too."""
    checked = scopes.where("complete AND successful").groupBy(F.col("run_id").alias("id")).agg(F.count("*").alias("verified_scopes"))
    whole = complete_runs(runs, scopes).select("id", "full_complete")
    judged = runs.where(F.col("source_name").isin(*names)).join(whole, "id").join(checked, "id", "left")
    sure = (F.col("status") == "success") & (F.col("verified_scopes") > 0) & ~(F.col("source_name").isin(*heavy) & F.col("bounded"))
    row, order = F.struct(F.col("id").alias("run"), "finished_at", "verified_scopes"), F.struct("started_at", "id")
    latest = judged.groupBy("source_name").agg(F.max_by(row, F.when(F.col("full_complete"), order)).alias("c"), F.max_by(row, F.when(sure, order)).alias("v"))
    every = runs.sparkSession.createDataFrame([(n, "heavy" if n in heavy else "light") for n in names], "source_name string, class string")
    return every.join(latest, "source_name", "left").select(
        "source_name", "class", F.col("c.run").alias("complete_run"), F.col("c.finished_at").alias("complete_finished_at"),
        F.col("v.run").alias("verified_run"), F.col("v.finished_at").alias("verified_finished_at"), F.coalesce("v.verified_scopes", F.lit(0)).alias("verified_scopes"),
    )


def recent_lifecycle(runs: DataFrame, scopes: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """The runs of the last days that report a lifecycle (deactivated, reactivated, canonical_closed; a run without one has null `deactivated`), with their completely verified scopes."""
    checked = scopes.where("complete AND successful").groupBy(F.col("run_id").alias("id")).agg(F.count("*").alias("complete_scopes"))
    recent = runs.where((F.col("started_at") >= now - hours(24 * days)) & F.col("deactivated").isNotNull()).join(checked, "id", "left")
    return recent.select("source_name", "id", "started_at", F.coalesce("complete_scopes", F.lit(0)).alias("complete_scopes"), "deactivated", F.coalesce("reactivated", F.lit(0)).alias("reactivated"), "canonical_closed")


def lifecycle_totals(recent: DataFrame) -> DataFrame:
    """One row: what the recent runs deactivated, reactivated and closed; closures are unknown (null) unless every run counts them."""
    closed = F.when(F.count("*") == F.count("canonical_closed"), F.sum("canonical_closed"))
    return recent.agg(F.count("*").alias("runs"), F.coalesce(F.sum("deactivated"), F.lit(0)).alias("deactivated"), F.coalesce(F.sum("reactivated"), F.lit(0)).alias("reactivated"), closed.alias("canonical_closed"))


def active_by_day(history: DataFrame, identity: list[str], now: Column, days: int = 7) -> DataFrame:
    """How many source rows were active as of the end of each of the last days (days_ago 0 is `now`). history: identity, source_name, is_active, at; a state stands until
    the identity's next one. Every state is held against the few days only, so no row of it is copied more than `days` times, and counts are summed before they are dealt out."""
    w = Window.partitionBy(*identity).orderBy("at", "is_active")
    spans = history.withColumn("until", F.lead("at").over(w)).where("is_active")
    at = lambda k: now - F.make_interval(days=k)
    stands = lambda k: (F.col("at") <= at(k)) & (F.col("until").isNull() | (at(k) < F.col("until")))
    each = spans.select("source_name", F.explode(F.filter(F.sequence(F.lit(0), F.lit(days - 1)), stands)).alias("days_ago"))
    return each.groupBy("source_name", "days_ago").agg(F.count("*").alias("active"))


def lifecycle_by_day(recent: DataFrame, active: DataFrame, now: Column) -> DataFrame:
    """For each source and day what its runs changed, beside what was active at the day's end."""
    ago = F.floor((F.unix_micros(now) - F.unix_micros("started_at")) / 86400e6).cast("int")
    changes = recent.groupBy("source_name", ago.alias("days_ago")).agg(F.count("*").alias("runs"), F.sum("deactivated").alias("deactivated"), F.sum("reactivated").alias("reactivated"))
    both = active.join(changes, ["source_name", "days_ago"], "full")
    return both.select("source_name", "days_ago", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("active", "runs", "deactivated", "reactivated")])


def freshness_report(classified: DataFrame, ages: DataFrame, families: DataFrame, verification: DataFrame | None = None, lifecycle: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """The report's frames as one long table (section, key, measure, value); times are unix seconds."""
    long = lambda df, section, key, cols: df.select(F.lit(section).alias("section"), F.coalesce(F.col(key), F.lit("total")).alias("key"), F.explode(F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))])).alias("measure", "value"))
    parts = [
        long(status_counts(classified, "freshness"), "class", "freshness", ["n"]),
        long(reason_counts(classified), "reason", "reason", ["n"]),
        long(ages, "age", "composition", [c for c in ages.columns if c != "composition"]),
        long(families, "family", "source_name", ["total", "active", "inactive", "jobs"]),
    ]
    if verification is not None:
        seconds = verification.withColumns({c: F.unix_seconds(c) for c in ("complete_finished_at", "verified_finished_at")})
        parts.append(long(seconds, "direct", "source_name", ["complete_finished_at", "verified_finished_at", "verified_scopes"]))
    if lifecycle is not None:
        parts.append(long(lifecycle.withColumn("key", F.lit("last_days")), "lifecycle", "key", ["runs", "deactivated", "reactivated", "canonical_closed"]))
    if days is not None:
        keyed = days.withColumn("key", F.concat_ws(":", "source_name", "days_ago"))
        parts.append(long(keyed, "day", "key", ["active", "runs", "deactivated", "reactivated"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
