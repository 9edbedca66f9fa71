"""Page logs, ownership, completion, and the reconciliation of what has disappeared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def check_page_log(rows: DataFrame, scope: str, page: str, id_col: str, payload: str, page_size: int, max_pages: int = 1000) -> DataFrame:
    """One row for each scope with the flags that forbid to call its inventory complete.

    A page's fingerprint is an order-free sum of row digests, so no page is gathered."""
    scoped = rows.groupBy(scope, page).agg(
        F.count("*").alias("n"), F.count_if(F.col(id_col).isNull()).alias("no_id"), F.sum(F.xxhash64(id_col, payload).cast("decimal(38,0)")).alias("print")
    )
    last, short = F.max(page), F.col("n") < page_size
    # Some short page lies before the last one if the first of them does. A lone short page without a number tells nothing.
    before_last = F.coalesce(F.min(F.when(short, F.col(page))) < last, F.when(F.count("*") > F.count_if(short & F.col(page).isNull()), F.lit(False)))
    by_page = scoped.groupBy(scope).agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_pages"),
        (F.sum("no_id") > 0).alias("missing_identity"),
        (F.count_distinct("print") < F.count("*")).alias("repeated_page"),
        (last > max_pages).alias("page_cap"),
        before_last.alias("short_page_contradiction"),
    )
    spread = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    ids = rows.where(F.col(id_col).isNotNull()).groupBy(scope, id_col).agg(spread(page).alias("overlaps"), spread(payload).alias("differs"))
    by_id = ids.groupBy(scope).agg(F.bool_or("overlaps").alias("cross_page_overlap"), F.bool_or("differs").alias("conflicting_duplicate"))
    out = by_page.join(by_id, scope, "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("cross_page_overlap", "conflicting_duplicate")})
    flags = [F.col(c) for c in ("missing_identity", "repeated_page", "cross_page_overlap", "conflicting_duplicate", "page_cap", "short_page_contradiction")]
    complete = ~flags[0]
    for f in flags[1:]:
        complete = complete & ~f
    return out.withColumn("complete", complete)


def canonical_activity(jobs: DataFrame, sources: DataFrame, job: str, direct: list[str]) -> DataFrame:
    """Active if a source is not known to be gone or is not direct; without sources the status stays. Times only advance."""
    alive = ~F.coalesce(F.col("is_active") == F.lit(False), F.lit(False)) | ~F.col("source_name").isin(*direct)
    seen = sources.groupBy(job).agg(F.bool_or(alive).alias("_alive"), F.max("last_seen_at").alias("_seen"))
    out = jobs.join(seen, job, "left")
    status = F.when(F.col("_alive").isNull(), F.col("status")).when(F.col("_alive"), "active").otherwise("inactive")
    return out.withColumns({"status": status, "last_seen_at": F.greatest("last_seen_at", "_seen")}).drop("_alive", "_seen")


def observed(rows: DataFrame, seen: DataFrame, on: list[str]) -> DataFrame:
    """Rows that the inventory has."""
    return rows.join(seen, on, "left_semi")


def missing(rows: DataFrame, seen: DataFrame, completion: DataFrame, scope: str, on: list[str]) -> DataFrame:
    """Rows that a complete inventory lacks; incomplete scopes prove nothing."""
    complete = completion.where("successful AND complete").select(scope)
    return rows.join(complete, scope, "left_semi").join(seen, on, "left_anti")


def owned_rows(sources: DataFrame, scopes: DataFrame, id_col: str, parts: list[str]) -> DataFrame:
    """Rows whose native id starts with exactly the scope's tokens, compared token by token."""
    tokens = sources
    for k, p in enumerate(parts):
        tokens = tokens.withColumn(p, F.split_part(id_col, F.lit(":"), F.lit(k + 1)))
    return tokens.where(F.size(F.split(id_col, ":")) == len(parts) + 1).join(scopes.select(*parts).distinct(), parts, "left_semi")


def resolve_ownership(sources: DataFrame, gate: DataFrame) -> DataFrame:
    """Sources (id, hosts, brand, tenant) against a reviewed gate (tenant, host, brand), one row for each source.

    EXACT: brand and host are one approved entry. LEGACY_DETERMINISTIC: no brand, and the tenant has one entry, whose host fits.
    AMBIGUOUS: several entries fit. REVIEW_REQUIRED: nothing fits. MALFORMED: no tenant or no host."""
    entries = gate.select("tenant", F.col("host").alias("g_host"), F.col("brand").alias("g_brand"))
    joined = sources.join(entries, "tenant", "left")
    fits = F.coalesce(F.array_contains("hosts", F.col("g_host")), F.lit(False))
    counted = joined.groupBy("id").agg(
        F.first("hosts").alias("hosts"),
        F.first("brand").alias("brand"),
        F.first("tenant").alias("tenant"),
        F.count_if(fits & (F.col("brand") == F.col("g_brand"))).alias("exact"),
        F.count_if(fits).alias("fitting"),
    )
    bad = F.col("tenant").isNull() | (F.col("tenant") == "") | (F.coalesce(F.size("hosts"), F.lit(0)) == 0)
    state = (
        F.when(bad, "MALFORMED")
        .when(F.col("exact") == 1, "EXACT")
        .when(F.col("brand").isNull() & (F.col("fitting") == 1), "LEGACY_DETERMINISTIC")
        .when(F.col("brand").isNull() & (F.col("fitting") > 1), "AMBIGUOUS")
        .otherwise("REVIEW_REQUIRED")
    )
    reason = F.when(bad, "missing_native_fields").when(state == "REVIEW_REQUIRED", F.when(F.col("fitting") == 0, "no_reviewed_scope").otherwise("brand_not_reviewed")).when(state == "AMBIGUOUS", "several_reviewed_scopes")
    return counted.select("id", state.alias("state"), reason.alias("reason"))


def ownership_report(resolved: DataFrame) -> DataFrame:
    """Rows by state, and whether they count as proof."""
    return resolved.groupBy("state").agg(F.count("*").alias("n"), F.bool_or(F.col("state").isin("EXACT", "LEGACY_DETERMINISTIC")).alias("authoritative"))


def completion(records: DataFrame, scopes: DataFrame, scope: str, rules: dict[str, Column] | None = None) -> DataFrame:
    """A scope is complete if no record failed, every id is proved, nothing was filtered or pruned, no veto stands, and none of the feed's own
    `rules` (name to condition on the scope row, in order) holds."""
    counted = records.groupBy(scope).agg(F.every(~F.col("failed")).alias("clean"), F.every(F.col("native_id").isNotNull()).alias("proved"))
    joined = scopes.join(counted, scope, "left")
    ok = lambda c: F.coalesce(c, F.lit(True))
    tests = {"record_failures": ~ok("clean"), "unproved_identity": ~ok("proved"), "filtered_inventory": F.col("filtered"), "pruned_inventory": F.col("pruned"), "policy_veto": F.col("veto"), **(rules or {})}
    reason = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in tests.items()], F.lit("complete"))
    return joined.select(scope, (reason == "complete").alias("complete"), reason.alias("reason"))


def gate_rules() -> dict[str, Column]:
    """G22 for pages behind a reviewed gate: the gate's rule is reviewed, nothing is quarantined, all advertised locales are covered, and one brand owns the
    site. Scope rows: reviewed, quarantined, locales, advertised_locales, brands."""
    return {
        "gate_not_reviewed": ~F.col("reviewed"),
        "quarantined": F.col("quarantined"),
        "locales_not_covered": F.size(F.array_except("advertised_locales", "locales")) > 0,
        "several_brands": F.size(F.array_distinct("brands")) != 1,
    }


def capped_examples(df: DataFrame, by: str, value: str, n: int = 10) -> DataFrame:
    """(by, total, examples): how many rows a group has, and its first n values. Ranks are cut within a task before they are shuffled."""
    first = df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(value))).where(F.col("_r") <= n)
    return df.groupBy(by).agg(F.count("*").alias("total")).join(first.groupBy(by).agg(F.sort_array(F.collect_list(value)).alias("examples")), by)


def reconcile_absence(sources: DataFrame, seen: DataFrame, scopes: DataFrame, scope: str, key: str, direct: list[str], now: Column) -> DataFrame:
    """Sources (key, scope, source_name, is_active, last_seen_at) after complete inventories. Seen rows become active; unseen active rows of
    complete scopes of direct sources become inactive; all else stays. `change` says which."""
    complete = scopes.where("successful AND complete").select(scope).distinct().withColumn("_complete", F.lit(True))
    marks = seen.select(scope, key).distinct().withColumn("_seen", F.lit(True))
    joined = sources.join(marks, [scope, key], "left").join(complete, scope, "left")
    is_seen, may = F.coalesce("_seen", F.lit(False)), F.coalesce("_complete", F.lit(False)) & F.col("source_name").isin(*direct)
    alive = F.coalesce("is_active", F.lit(True))
    change = F.when(is_seen & ~alive, "reactivated").when(is_seen, "observed").when(may & alive, "deactivated").otherwise("unchanged")
    return joined.withColumn("change", change).withColumns({
        "is_active": F.when(F.col("change").isin("reactivated", "observed"), F.lit(True)).when(F.col("change") == "deactivated", F.lit(False)).otherwise(F.col("is_active")),
        "last_seen_at": F.when(is_seen, now).otherwise(F.col("last_seen_at")),
    }).drop("_seen", "_complete")


def lifecycle_summary(reconciled: DataFrame, scope: str) -> DataFrame:
    """What a run changed, by scope, with a total (null scope)."""
    count = lambda *names: F.count_if(F.col("change").isin(*names))
    return reconciled.rollup(scope).agg(count("observed", "reactivated").alias("observed"), count("deactivated").alias("deactivated"), count("reactivated").alias("reactivated"))


def discover_scopes(rows: DataFrame, identities: Column, company: str) -> DataFrame:
    """Rows whose urls agree on one scope, by scope: rows, and the company if all agree on it."""
    known = F.array_distinct(F.array_compact(identities))
    agreed = rows.withColumn("scope", F.when(F.size(known) == 1, known[0])).where("scope IS NOT NULL")
    one = F.min(company) == F.max(company)
    return agreed.groupBy("scope").agg(F.count("*").alias("n"), F.when(one, F.min(company)).alias("company"), F.coalesce(~one, F.lit(False)).alias("mixed"))


def choose_variant(rows: DataFrame, id_col: str, eligible: str, position: str, value: str) -> DataFrame:
    """Groups with an eligible variant, and the first eligible one."""
    return rows.groupBy(id_col).agg(F.bool_or(eligible).alias("_any"), F.min_by(value, F.struct(~F.col(eligible), F.col(position), F.col(value))).alias(value)).where("_any").drop("_any")


def identity_manifest(observations: DataFrame, existing: DataFrame, scope: str) -> DataFrame:
    """Proved, unknown, distinct and conflicting identities of a scope, and how many of them were known before."""
    by_id = observations.where("native_id IS NOT NULL").groupBy(scope, "native_id").agg(F.count("*").alias("n"), (F.min("payload") != F.max("payload")).alias("conflict"))
    known = by_id.join(existing.select(scope, "native_id").distinct().withColumn("_old", F.lit(True)), [scope, "native_id"], "left")
    proved = known.groupBy(scope).agg(F.sum("n").alias("proved"), F.count("*").alias("distinct"), F.count_if("conflict").alias("conflicts"), F.count_if(F.col("_old")).alias("existing_seen"))
    total = observations.groupBy(scope).agg(F.count("*").alias("total"), F.count_if(F.col("native_id").isNull()).alias("unknown"))
    out = total.join(proved, scope, "left").fillna(0, ["proved", "distinct", "conflicts", "existing_seen"])
    return out.withColumns({"new": F.col("distinct") - F.col("existing_seen"), "complete": (F.col("unknown") == 0) & (F.col("conflicts") == 0)})


def check_manifest(manifest: DataFrame, scope: str) -> DataFrame:
    """Rows whose accounting does not add up."""
    problem = F.when(F.col("proved") + F.col("unknown") != F.col("total"), "total_mismatch").when(F.col("distinct") > F.col("proved"), "distinct_exceeds_proved").when(F.col("complete") & (F.col("unknown") > 0), "false_claim")
    return manifest.select(scope, problem.alias("problem")).where("problem IS NOT NULL")


def quality_ledger(failures: DataFrame, scope: str, examples: int = 10) -> DataFrame:
    """Failures (scope, kind, stage, identity, signature, count) as totals, with the first few signatures of each scope.

    Signatures are summed first, so an example list never sees more rows than there are signatures."""
    known = F.col("identity").isNotNull()
    by = failures.groupBy(scope, "kind", "stage", known.alias("known"), F.coalesce("signature", "kind").alias("signature")).agg(F.sum("count").alias("n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    required, fetch = F.col("stage").isin("required", "identity"), F.col("stage") == "detail_fetch"
    ranked = by.withColumn("_r", F.row_number().over(Window.partitionBy(scope).orderBy(F.desc("n"), "kind", "stage", "signature", "known")))
    out = ranked.groupBy(scope).agg(
        total(F.col("known")).alias("identity_preserving"),
        total(~F.col("known")).alias("identity_unknown"),
        total(required).alias("required_failures"),
        total(F.col("stage") == "enrichment").alias("optional_failures"),
        total(fetch).alias("fetch_failures"),
        F.sort_array(F.collect_list(F.when(F.col("_r") <= examples, F.struct("_r", "signature", "n")))).alias("_examples"),
    )
    alert = (F.col("identity_unknown") > 0) | (F.col("required_failures") > 0) | (F.col("fetch_failures") > 0)
    return out.withColumns({"alert_worthy": alert, "examples": F.transform("_examples", lambda x: F.concat_ws("=", x["signature"], x["n"].cast("string")))}).drop("_examples")


def legacy_quality(rows: DataFrame) -> DataFrame:
    """Old counters read again: a failed run's counter is no record count; shells without a proved 404 stay uncertain."""
    failed = F.when(F.col("status") != "success", F.lit(0)).otherwise(F.col("failed"))
    missing_ids = F.col("missing_path") + F.col("missing_identity")
    shells = F.greatest(F.lit(0), F.col("withdrawn") - F.col("proved_404"))
    all_failed = F.greatest(failed, missing_ids, F.col("detail_errors"))
    return rows.select(
        "id", (missing_ids + shells).alias("identity_unknown"), F.greatest(F.lit(0), all_failed - missing_ids).alias("unclassified"), (all_failed + shells).alias("failures"), ((all_failed > 0) | (shells > 0)).alias("alert_worthy")
    )


def attempt_rollup(attempts: DataFrame, by: list[str]) -> DataFrame:
    """Requests, retries, recovered and exhausted requests."""
    each = attempts.groupBy(*by, "request").agg(F.count("*").alias("n"), F.max_by("ok", "attempt").alias("ok"))
    return each.groupBy(*by).agg(F.count("*").alias("requests"), F.sum(F.col("n") - 1).alias("retries"), F.count_if(F.col("ok") & (F.col("n") > 1)).alias("recovered"), F.count_if(~F.col("ok")).alias("exhausted"))


def run_status(scopes: DataFrame, run: str) -> DataFrame:
    """A run failed only if something was asked for and nothing succeeded."""
    out = scopes.groupBy(run).agg(F.count("*").alias("requested"), F.count_if("successful").alias("succeeded"))
    return out.withColumn("status", F.when((F.col("requested") > 0) & (F.col("succeeded") == 0), "failed").otherwise("success"))


def scope_accounting(scopes: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs whose scope rows are missing, repeated or do not sum up."""
    seen = scopes.groupBy("run_id").agg(F.count("*").alias("rows"), F.count_distinct("scope").alias("scopes"), F.sum("failed").alias("failed"))
    joined = runs.join(seen, "run_id", "left").fillna(0, ["rows", "scopes", "failed"])
    problem = F.when(F.col("rows") != F.col("scopes"), "duplicate_scope").when(F.col("scopes") < F.col("requested"), "missing_scope").when(F.col("failed") != F.col("failed_total"), "failed_mismatch")
    return joined.select("run_id", problem.alias("problem")).where("problem IS NOT NULL")
