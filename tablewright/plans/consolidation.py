"""Queries of merging, lifecycle and health operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import freshness as H
from tablewright.operators import lifecycle as C
from tablewright.operators import linkage as L
from tablewright.operators import merging as M
from tablewright.plans import table
from tablewright.sources import snapshots as SN

Q: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        Q[name] = (fn, sql)
        return fn

    return keep


def stamp(text: str):
    return F.lit(text).cast("timestamp")


def now():
    return stamp("2024-01-31 00:00:00")


T_NOW = "TIMESTAMP '2024-01-31'"


def events(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# --- page logs, snapshots, updates -------------------------------------------------------------------------------------------------


@query("s11_page_log", """WITH r AS (SELECT l_orderkey AS scope, l_linenumber AS page, CASE WHEN l_quantity = 1 THEN NULL ELSE l_partkey % 50 END AS id, CAST(l_suppkey AS VARCHAR) AS payload FROM lineitem),
p AS (SELECT scope, page, count(*) AS n, count(*) FILTER (WHERE id IS NULL) AS no_id, string_agg(coalesce(CAST(id AS VARCHAR), '-') || ':' || payload, ',' ORDER BY id, payload) AS print FROM r GROUP BY 1, 2),
l AS (SELECT *, max(page) OVER (PARTITION BY scope) AS last_page FROM p),
bp AS (SELECT scope, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_pages, sum(no_id) > 0 AS missing_identity, count(DISTINCT print) < count(*) AS repeated_page, max(page) > 6 AS page_cap, bool_or(n < 2 AND page < last_page) AS short_page_contradiction FROM l GROUP BY 1),
i AS (SELECT scope, id, count(DISTINCT page) AS pages, min(payload) <> max(payload) AS differs FROM r WHERE id IS NOT NULL GROUP BY 1, 2),
bi AS (SELECT scope, bool_or(pages > 1) AS cross_page_overlap, bool_or(differs) AS conflicting_duplicate FROM i GROUP BY 1)
SELECT scope, n_rows, n_pages, missing_identity, repeated_page, page_cap, short_page_contradiction, coalesce(cross_page_overlap, false) AS cross_page_overlap, coalesce(conflicting_duplicate, false) AS conflicting_duplicate, NOT (missing_identity OR repeated_page OR page_cap OR short_page_contradiction OR coalesce(cross_page_overlap, false) OR coalesce(conflicting_duplicate, false)) AS complete FROM bp LEFT JOIN bi USING (scope)""")
def s11(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("scope"), F.col("l_linenumber").alias("page"), F.when(F.col("l_quantity") != 1, F.col("l_partkey") % 50).alias("id"), F.col("l_suppkey").cast("string").alias("payload"))
    return C.check_page_log(r, "scope", "page", "id", "payload", page_size=2, max_pages=6)


@query("s12_load_jobs", "SELECT o_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS sources FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def s12(spark, d):
    jobs = SN.load_jobs(table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", ["l_linenumber", "l_partkey"])
    return jobs.select("o_orderkey", F.array_join(F.transform("sources", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"])), ",").alias("sources"))


@query("s13_freshness_snapshot", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS scope, event_type AS state, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type <> 'error'")
def s13(spark, d):
    rows = SN.freshness_snapshot(events(spark, d).where("event_type <> 'error'"), "props", ["event_id", "event_type", "ts"], {"scope": "$.k", "country": "$.country"})
    return rows.select("event_id", F.col("scope").cast("long").alias("scope"), F.col("event_type").alias("state"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("s15_upsert_snapshot", "WITH b AS (SELECT l_orderkey AS o_orderkey, max(l_extendedprice) AS v FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1) SELECT coalesce(o.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(v, o_totalprice) AS value, CASE WHEN o.o_orderkey IS NULL THEN 'created' WHEN b.o_orderkey IS NULL THEN 'kept' ELSE 'updated' END AS change FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') o FULL JOIN b ON o.o_orderkey = b.o_orderkey")
def s15(spark, d):
    """The snapshot holds all orders that are not pending, the batch those shipped since a day."""
    snapshot = table(spark, d, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_totalprice").alias("value"))
    batch = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("value"))
    return M.upsert_snapshot(snapshot, batch, ["o_orderkey"])


@query("s17_append_versions", "SELECT DISTINCT lang, n_chars % 500 AS h FROM documents WHERE source >= 'src1' EXCEPT SELECT lang, n_chars % 500 FROM documents WHERE source < 'src1'")
def s17(spark, d):
    """The sources before src1 are there already, all others are new."""
    v = table(spark, d, "documents").select("source", "lang", (F.col("n_chars") % 500).alias("h"))
    return M.append_new(v.where("source < 'src1'").drop("source").distinct(), v.where("source >= 'src1'").drop("source"), ["lang", "h"])


@query("s19_dimension_check", """WITH p AS (SELECT c_custkey AS scope, CASE c_custkey % 5 WHEN 0 THEN 'odd' ELSE 'known_gap' END AS state, c_custkey % 7 - 1 AS days FROM customer)
SELECT CAST(scope AS VARCHAR) AS subject, CASE WHEN state = 'odd' THEN 'unknown_state' WHEN days <= 0 THEN 'dates_out_of_order' WHEN days * 10 > 31 THEN 'review_too_long' END AS problem FROM p WHERE state = 'odd' OR days <= 0 OR days * 10 > 31
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'no_country' FROM supplier WHERE s_suppkey % 4 = 3""")
def s19(spark, d):
    """Policies with states and dates out of order, and labels that the dimension of countries must know."""
    from tablewright.sources.dimensions import check_policies, load_dimension

    c = table(spark, d, "customer")
    p = c.select(F.col("c_custkey").alias("scope"), F.when(F.col("c_custkey") % 5 == 0, "odd").otherwise("known_gap").alias("state"), now().alias("reviewed_at"), F.expr("c_custkey % 7 - 1").alias("days"))
    p = p.withColumn("review_expires_at", F.col("reviewed_at") + F.make_interval(days=(F.col("days") * 10).cast("int")))
    bad = check_policies(p, ("known_gap",), ["scope"]).select(F.col("scope").cast("string").alias("subject"), "problem")
    name = F.element_at(F.array(*map(F.lit, ("new zealand", "cze", "deutschland", "atlantis"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    unknown = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("subject"), name.alias("alias")).join(load_dimension(spark, "countries"), "alias", "left_anti")
    return bad.unionByName(unknown.select("subject", F.lit("no_country").alias("problem")))


@query("p13_guarded_update", """WITH top AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'N' THEN 300 ELSE 100 END) AS p FROM lineitem GROUP BY 1),
i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 200 ELSE 100 END AS p, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'Unknown position' ELSE 'new' END AS title, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'remote' END AS mode FROM orders WHERE o_orderkey % 4 <> 3),
c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE 'old' END AS title, CASE WHEN o_orderkey % 3 = 1 THEN 'unknown' ELSE 'onsite' END AS remote_type FROM orders)
SELECT c.o_orderkey, CASE WHEN i.p IS NULL THEN c.title WHEN i.p >= coalesce(top.p, 0) THEN coalesce(i.title, c.title) WHEN trim(c.title) = '' AND i.title IS NOT NULL AND i.title <> 'Unknown position' THEN i.title ELSE c.title END AS title,
CASE WHEN i.p IS NULL THEN c.remote_type WHEN i.p >= coalesce(top.p, 0) THEN i.mode WHEN c.remote_type = 'unknown' AND i.mode IS NOT NULL THEN i.mode ELSE c.remote_type END AS remote_type, i.p IS NOT NULL AS advanced
FROM c LEFT JOIN i USING (o_orderkey) LEFT JOIN top ON c.o_orderkey = l_orderkey""")
def p13(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    current = o.select("o_orderkey", F.when(k % 3 == 0, " ").otherwise("old").alias("title"), F.when(k % 3 == 1, "unknown").otherwise("onsite").alias("remote_type"))
    incoming = o.where(k % 4 != 3).select("o_orderkey", F.when(k % 2 == 0, 200).otherwise(100).alias("priority"), F.when(k % 5 == 0, None).when(k % 5 == 1, "Unknown position").otherwise("new").alias("title"), F.when(k % 7 == 0, None).otherwise("remote").alias("remote_type"))
    backing = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_returnflag") == "N", 300).otherwise(100).alias("priority"))
    out = M.guarded_update(current, incoming, backing, "o_orderkey", ["title", "remote_type"], now(), preserve_if_none=("title",))
    return out.select("o_orderkey", "title", "remote_type", F.col("last_seen_at").isNotNull().alias("advanced"))


@query("r03_apply_merges", """WITH p AS (SELECT a.o_orderkey AS a, b.o_orderkey AS b, CAST(floor(a.o_totalprice) AS INT) % 3 AS pa, CAST(floor(b.o_totalprice) AS INT) % 3 AS pb FROM orders a JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderkey > a.o_orderkey), e AS (SELECT id FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) GROUP BY id HAVING count(*) = 1),
g AS (SELECT CASE WHEN pa > pb THEN a ELSE b END AS kept, CASE WHEN pa > pb THEN b ELSE a END AS removed FROM p WHERE pa <> pb AND a IN (SELECT id FROM e) AND b IN (SELECT id FROM e))
SELECT o.o_orderkey AS id, CASE WHEN o.o_orderstatus = 'P' THEN coalesce(r.o_orderstatus, o.o_orderstatus) ELSE o.o_orderstatus END AS title, strftime(least(o.o_orderdate, r.o_orderdate), '%Y-%m-%d') AS first_seen_at FROM orders o LEFT JOIN g ON g.kept = o.o_orderkey LEFT JOIN orders r ON r.o_orderkey = g.removed WHERE o.o_orderkey NOT IN (SELECT removed FROM g)""")
def r03(spark, d):
    o = table(spark, d, "orders")
    jobs = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("title"), F.col("o_orderdate").alias("first_seen_at"), F.col("o_orderstatus").alias("own"))
    held = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b"), F.count("*").alias("n"))
    pairs = held.where("n = 2").select("a", "b")  # orders that are their customer's only two
    priority = o.select(F.col("o_orderkey").alias("id"), (F.floor("o_totalprice").cast("int") % 3).alias("priority"))
    plan = M.merge_plan(pairs, priority)
    new, _, _ = M.apply_merges(plan, jobs, o.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("job_id")), ["title"], ["first_seen_at"], [], dry_run=False)
    return new.select("id", F.when(F.col("title") == " ", "P").otherwise(F.col("title")).alias("title"), F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen_at"))


# --- lifecycle ---------------------------------------------------------------------------------------------------------------------


@query("g04_canonical_activity", "SELECT o_orderkey, CASE WHEN n IS NULL THEN o_orderstatus WHEN alive THEN 'active' ELSE 'inactive' END AS status, strftime(greatest(o_orderdate, coalesce(seen, o_orderdate)), '%Y-%m-%d') AS last_seen FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, bool_or(l_linestatus <> 'F' OR l_returnflag = 'R') AS alive, max(l_shipdate) AS seen FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def g04(spark, d):
    jobs = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("last_seen_at"))
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("source_name"), (F.col("l_linestatus") != "F").alias("is_active"), F.col("l_shipdate").alias("last_seen_at"))
    return C.canonical_activity(jobs, s, "o_orderkey", ["A", "N"]).select("o_orderkey", "status", F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"))


def inventory(spark, d):
    """Sources: what users had before 2024-01-20. Seen: what they had after. A user's scope is complete without an error on the last days."""
    e = events(spark, d).withColumn("key", F.get_json_object("props", "$.k"))
    sources = e.where(F.col("ts") < stamp("2024-01-20")).groupBy(F.col("user_id").alias("scope"), "key").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("source_name"), F.max("ts").alias("last_seen_at"))
    sources = sources.withColumn("is_active", F.when(F.col("source_name") == "view", None).otherwise(F.col("source_name") != "signup"))
    late = e.where(F.col("ts") >= stamp("2024-01-20"))
    scopes = late.groupBy(F.col("user_id").alias("scope")).agg(F.lit(True).alias("successful"), (F.count_if((F.col("event_type") == "error") & (F.col("ts") >= stamp("2024-01-29"))) == 0).alias("complete"))
    return sources, late.select(F.col("user_id").alias("scope"), "key").distinct(), scopes


INVENTORY = """e AS (SELECT *, json_extract_string(props, '$.k') AS key FROM events),
src AS (SELECT user_id AS scope, key, arg_max(event_type, (ts, event_id)) AS source_name FROM e WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
sources AS (SELECT *, CASE WHEN source_name = 'view' THEN NULL ELSE source_name <> 'signup' END AS is_active FROM src),
seen AS (SELECT DISTINCT user_id AS scope, key FROM e WHERE ts >= TIMESTAMP '2024-01-20'),
scopes AS (SELECT user_id AS scope, count(*) FILTER (WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-29') = 0 AS complete FROM e WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1)"""


@query("j14_observed_missing", f"WITH {INVENTORY} SELECT s.scope, count(*) FILTER (WHERE n.key IS NOT NULL) AS observed, count(*) FILTER (WHERE n.key IS NULL AND c.complete) AS missing FROM sources s LEFT JOIN seen n USING (scope, key) LEFT JOIN scopes c ON c.scope = s.scope GROUP BY 1")
def j14(spark, d):
    sources, seen, scopes = inventory(spark, d)
    obs = C.observed(sources, seen, ["scope", "key"]).groupBy("scope").agg(F.count("*").alias("observed"))
    miss = C.missing(sources, seen, scopes, "scope", ["scope", "key"]).groupBy("scope").agg(F.count("*").alias("missing"))
    return sources.select("scope").distinct().join(obs, "scope", "left").join(miss, "scope", "left").fillna(0, ["observed", "missing"])


CHANGE = "CASE WHEN n.key IS NOT NULL AND NOT coalesce(s.is_active, true) THEN 'reactivated' WHEN n.key IS NOT NULL THEN 'observed' WHEN coalesce(c.complete, false) AND s.source_name IN ('signup', 'view', 'click', 'purchase') AND coalesce(s.is_active, true) THEN 'deactivated' ELSE 'unchanged' END"
DIRECT_EVENTS = ["signup", "view", "click", "purchase"]


@query("r05_reconcile_absence", f"WITH {INVENTORY}, x AS (SELECT s.scope, s.key, s.is_active, {CHANGE} AS change FROM sources s LEFT JOIN seen n USING (scope, key) LEFT JOIN scopes c ON c.scope = s.scope) SELECT scope, key, change, CASE WHEN change IN ('reactivated', 'observed') THEN true WHEN change = 'deactivated' THEN false ELSE is_active END AS is_active FROM x")
def r05(spark, d):
    sources, seen, scopes = inventory(spark, d)
    return C.reconcile_absence(sources, seen, scopes, "scope", "key", DIRECT_EVENTS, now()).select("scope", "key", "change", "is_active")


@query("g06_lifecycle_summary", f"WITH {INVENTORY}, x AS (SELECT s.scope, {CHANGE} AS change FROM sources s LEFT JOIN seen n USING (scope, key) LEFT JOIN scopes c ON c.scope = s.scope) SELECT scope, count(*) FILTER (WHERE change IN ('observed', 'reactivated')) AS observed, count(*) FILTER (WHERE change = 'deactivated') AS deactivated, count(*) FILTER (WHERE change = 'reactivated') AS reactivated FROM x GROUP BY ROLLUP (scope)")
def g06(spark, d):
    sources, seen, scopes = inventory(spark, d)
    return C.lifecycle_summary(C.reconcile_absence(sources, seen, scopes, "scope", "key", DIRECT_EVENTS, now()), "scope")


@query("j15_owned_rows", "SELECT page_id FROM pages WHERE split_part(url, '/', 4) IN ('en', 'de') AND page_id % 3 <> 0")
def j15(spark, d):
    p = table(spark, d, "pages").withColumn("lang", F.split_part("url", F.lit("/"), F.lit(4)))
    rows = p.select("page_id", F.concat_ws(":", F.lit("t"), "lang", F.when(F.col("page_id") % 3 == 0, F.lit("a:b")).otherwise(F.col("page_id").cast("string"))).alias("native"))
    scopes = p.where("lang IN ('en', 'de')").select(F.lit("t").alias("tenant"), F.col("lang").alias("site")).distinct()
    return C.owned_rows(rows, scopes, "native", ["tenant", "site"]).select("page_id")


def ownership(spark, d):
    n = table(spark, d, "nation")
    gate = n.where("n_regionkey <= 2").select(F.col("n_regionkey").cast("string").alias("tenant"), F.col("n_name").alias("host"), F.concat(F.lit("B"), F.col("n_nationkey") % 3).alias("brand"))
    c = table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    rows = c.select(k.alias("id"), F.when(k % 11 != 0, F.col("n_regionkey").cast("string")).alias("tenant"), F.when(k % 5 == 0, F.array("n_name", F.concat(F.lit("NATION_"), (F.col("n_nationkey") + 5) % 25))).otherwise(F.array("n_name")).alias("hosts"), F.when(k % 3 == 0, F.concat(F.lit("B"), F.col("n_nationkey") % 3)).when(k % 3 == 1, F.lit("B9")).alias("brand"))
    return rows, gate


OWN = """g AS (SELECT CAST(n_regionkey AS VARCHAR) AS tenant, n_name AS host, 'B' || (n_nationkey % 3) AS brand FROM nation WHERE n_regionkey <= 2),
r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 11 <> 0 THEN CAST(n_regionkey AS VARCHAR) END AS tenant, CASE WHEN c_custkey % 5 = 0 THEN [n_name, 'NATION_' || ((n_nationkey + 5) % 25)] ELSE [n_name] END AS hosts, CASE WHEN c_custkey % 3 = 0 THEN 'B' || (n_nationkey % 3) WHEN c_custkey % 3 = 1 THEN 'B9' END AS brand FROM customer JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT r.id, any_value(r.tenant) AS tenant, any_value(r.brand) AS brand, count(*) FILTER (WHERE list_contains(hosts, g.host) AND r.brand = g.brand) AS exact, count(*) FILTER (WHERE list_contains(hosts, g.host)) AS fitting FROM r LEFT JOIN g ON r.tenant = g.tenant GROUP BY 1),
o AS (SELECT id, CASE WHEN tenant IS NULL THEN 'MALFORMED' WHEN exact = 1 THEN 'EXACT' WHEN brand IS NULL AND fitting = 1 THEN 'LEGACY_DETERMINISTIC' WHEN brand IS NULL AND fitting > 1 THEN 'AMBIGUOUS' ELSE 'REVIEW_REQUIRED' END AS state FROM m)"""


@query("j16_resolve_ownership", f"WITH {OWN} SELECT id, state FROM o")
def j16(spark, d):
    return C.resolve_ownership(*ownership(spark, d)).select("id", "state")


@query("g15_ownership_report", f"WITH {OWN} SELECT state, count(*) AS n, state IN ('EXACT', 'LEGACY_DETERMINISTIC') AS authoritative FROM o GROUP BY state")
def g15(spark, d):
    return C.ownership_report(C.resolve_ownership(*ownership(spark, d)))


@query("g22_completion", """WITH c AS (SELECT user_id AS scope, bool_and(NOT (event_type = 'error' AND value > 100)) AS clean, bool_and(value > 0.05) AS proved FROM events GROUP BY 1), s AS (SELECT DISTINCT user_id AS scope FROM events)
SELECT scope, CASE WHEN NOT clean THEN 'record_failures' WHEN NOT proved THEN 'unproved_identity' WHEN scope % 10 = 1 THEN 'filtered_inventory' WHEN scope % 10 = 2 THEN 'pruned_inventory' WHEN scope % 10 = 3 THEN 'policy_veto' WHEN scope % 10 = 4 THEN 'gate_not_reviewed' WHEN scope % 10 = 5 THEN 'quarantined' WHEN scope % 10 = 6 THEN 'locales_not_covered' WHEN scope % 10 = 7 THEN 'several_brands' ELSE 'complete' END AS reason FROM s JOIN c USING (scope)""")
def g22(spark, d):
    e = events(spark, d)
    records = e.select(F.col("user_id").alias("scope"), ((F.col("event_type") == "error") & (F.col("value") > 100)).alias("failed"), F.when(F.col("value") > 0.05, F.col("event_id")).alias("native_id"))
    k = F.col("scope") % 10
    words = lambda *w: F.array(*map(F.lit, w))
    scopes = e.select(F.col("user_id").alias("scope")).distinct().withColumns({"filtered": k == 1, "pruned": k == 2, "veto": k == 3, "reviewed": k != 4, "quarantined": k == 5, "locales": words("cs", "en"), "advertised_locales": F.when(k == 6, words("cs", "de")).otherwise(words("en", "cs")), "brands": F.when(k == 7, words("a", "b")).otherwise(words("a", "a"))})
    return C.completion(records, scopes, "scope", C.gate_rules()).select("scope", "reason")


@query("g02_discover_scopes", "SELECT lang AS scope, count(*) AS n, CASE WHEN min(tld) = max(tld) THEN min(tld) END AS company, min(tld) <> max(tld) AS mixed FROM (SELECT page_id, split_part(url, '/', 4) AS lang, regexp_extract(url, 'example\\.([a-z]+)', 1) AS tld FROM pages) WHERE page_id % 4 <> 0 OR lang = 'en' GROUP BY 1")
def g02(spark, d):
    p = table(spark, d, "pages").withColumn("lang", F.split_part("url", F.lit("/"), F.lit(4))).withColumn("tld", F.regexp_extract("url", r"example\.([a-z]+)", 1))
    return C.discover_scopes(p, F.array("lang", F.when(F.col("page_id") % 4 == 0, F.lit("en"))), "tld")


@query("g03_choose_variant", "SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r FROM lineitem WHERE l_returnflag = 'A') WHERE r = 1")
def g03(spark, d):
    li = table(spark, d, "lineitem").withColumn("ok", F.col("l_returnflag") == "A")
    return C.choose_variant(li, "l_orderkey", "ok", "l_linenumber", "l_partkey")


MANIFEST = """b AS (SELECT user_id AS scope, json_extract_string(props, '$.k') AS id, event_type AS payload, ts FROM events),
o AS (SELECT scope, CASE WHEN payload = 'error' THEN NULL ELSE id END AS id, payload FROM b WHERE ts >= TIMESTAMP '2024-01-20'),
i AS (SELECT scope, id, count(*) AS n, min(payload) <> max(payload) AS conflict FROM o WHERE id IS NOT NULL GROUP BY 1, 2),
x AS (SELECT DISTINCT scope, id FROM b WHERE ts < TIMESTAMP '2024-01-10'),
p AS (SELECT i.scope, CAST(sum(n) AS BIGINT) AS proved, count(*) AS "distinct", count(*) FILTER (WHERE conflict) AS conflicts, count(x.id) AS existing_seen FROM i LEFT JOIN x USING (scope, id) GROUP BY 1),
t AS (SELECT scope, count(*) AS total, count(*) FILTER (WHERE id IS NULL) AS unknown FROM o GROUP BY 1)"""


@query("g13_identity_manifest", f'WITH {MANIFEST} SELECT t.scope, total, unknown, coalesce(proved, 0) AS proved, coalesce("distinct", 0) AS "distinct", coalesce(conflicts, 0) AS conflicts, coalesce(existing_seen, 0) AS existing_seen, coalesce("distinct", 0) - coalesce(existing_seen, 0) AS "new", unknown = 0 AND coalesce(conflicts, 0) = 0 AS complete FROM t LEFT JOIN p USING (scope)')
def g13(spark, d):
    b = events(spark, d).select(F.col("user_id").alias("scope"), F.get_json_object("props", "$.k").alias("native_id"), F.col("event_type").alias("payload"), "ts")
    o = b.where(F.col("ts") >= stamp("2024-01-20")).withColumn("native_id", F.when(F.col("payload") != "error", F.col("native_id")))
    return C.identity_manifest(o, b.where(F.col("ts") < stamp("2024-01-10")), "scope")


@query("g14_check_manifest", "SELECT c_custkey AS scope, CASE WHEN c_custkey % 5 = 0 THEN 'total_mismatch' WHEN c_custkey % 5 = 1 THEN 'distinct_exceeds_proved' ELSE 'false_claim' END AS problem FROM customer WHERE c_custkey % 5 < 3")
def g14(spark, d):
    k = F.col("c_custkey") % 5
    m = table(spark, d, "customer").select(F.col("c_custkey").alias("scope"), F.when(k == 0, 9).otherwise(10).alias("total"), F.lit(8).alias("proved"), F.lit(2).alias("unknown"), F.when(k == 1, 9).otherwise(7).alias("distinct"), (k == 2).alias("complete"))
    return C.check_manifest(m, "scope")


@query("g11_quality_ledger", """WITH f AS (SELECT user_id AS scope, event_type AS kind, CASE event_type WHEN 'view' THEN 'enrichment' WHEN 'click' THEN 'detail_fetch' ELSE 'required' END AS stage, value > 10 AS known, 'k' || (event_id % 3) AS signature FROM events WHERE event_type <> 'signup'), b AS (SELECT scope, kind, stage, known, signature, count(*) AS n FROM f GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY n DESC, kind, stage, signature, known) AS r FROM b)
SELECT scope, CAST(coalesce(sum(n) FILTER (WHERE known), 0) AS BIGINT) AS identity_preserving, CAST(coalesce(sum(n) FILTER (WHERE NOT known), 0) AS BIGINT) AS identity_unknown, CAST(coalesce(sum(n) FILTER (WHERE stage = 'required'), 0) AS BIGINT) AS required_failures, CAST(coalesce(sum(n) FILTER (WHERE stage = 'enrichment'), 0) AS BIGINT) AS optional_failures, CAST(coalesce(sum(n) FILTER (WHERE stage = 'detail_fetch'), 0) AS BIGINT) AS fetch_failures, string_agg(signature || '=' || n, ',' ORDER BY r) FILTER (WHERE r <= 3) AS examples,
coalesce(sum(n) FILTER (WHERE NOT known OR stage <> 'enrichment'), 0) > 0 AS alert_worthy FROM r GROUP BY scope""")
def g11(spark, d):
    t = F.col("event_type")
    f = events(spark, d).where("event_type <> 'signup'").select(F.col("user_id").alias("scope"), t.alias("kind"), F.when(t == "view", "enrichment").when(t == "click", "detail_fetch").otherwise("required").alias("stage"), F.when(F.col("value") > 10, F.col("event_id")).alias("identity"), F.concat(F.lit("k"), F.col("event_id") % 3).alias("signature"), F.lit(1).alias("count"))
    return C.quality_ledger(f, "scope", 3).withColumn("examples", F.array_join("examples", ","))


@query("t05_capped_examples", "SELECT user_id, count(*) AS total, string_agg(event_id, ',' ORDER BY event_id) FILTER (WHERE r <= 10) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events WHERE event_type = 'error') GROUP BY 1")
def t05(spark, d):
    return C.capped_examples(events(spark, d).where("event_type = 'error'"), "user_id", "event_id").withColumn("examples", F.array_join("examples", ","))


@query("g12_legacy_quality", """WITH c AS (SELECT user_id AS id, CASE WHEN user_id % 4 = 0 THEN 'failed' ELSE 'success' END AS status, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'view' AND value < 2) AS mp, count(*) FILTER (WHERE event_type = 'click' AND value < 2) AS mi, count(*) FILTER (WHERE event_type = 'signup' AND value < 4) AS w, count(*) FILTER (WHERE event_type = 'purchase' AND value < 4) AS p, count(*) FILTER (WHERE value > 40) AS de FROM events GROUP BY 1),
x AS (SELECT *, mp + mi AS miss, greatest(0, w - p) AS shells, greatest(CASE WHEN status <> 'success' THEN 0 ELSE failed END, mp + mi, de) AS af FROM c) SELECT id, miss + shells AS identity_unknown, greatest(0, af - miss) AS unclassified, af + shells AS failures, af > 0 OR shells > 0 AS alert_worthy FROM x""")
def g12(spark, d):
    n = lambda c: F.count_if(F.expr(c))
    rows = events(spark, d).groupBy(F.col("user_id").alias("id")).agg(
        n("event_type = 'error'").alias("failed"), n("event_type = 'view' AND value < 2").alias("missing_path"), n("event_type = 'click' AND value < 2").alias("missing_identity"), n("event_type = 'signup' AND value < 4").alias("withdrawn"), n("event_type = 'purchase' AND value < 4").alias("proved_404"), n("value > 40").alias("detail_errors")
    )
    return C.legacy_quality(rows.withColumn("status", F.when(F.col("id") % 4 == 0, "failed").otherwise("success")))


@query("g16_attempt_rollup", "WITH e AS (SELECT event_type, json_extract_string(props, '$.k') AS request, count(*) AS n, arg_max(value > 10, (ts, event_id)) AS ok FROM events GROUP BY 1, 2) SELECT event_type, count(*) AS requests, CAST(sum(n - 1) AS BIGINT) AS retries, count(*) FILTER (WHERE ok AND n > 1) AS recovered, count(*) FILTER (WHERE NOT ok) AS exhausted FROM e GROUP BY 1")
def g16(spark, d):
    a = events(spark, d).select("event_type", F.get_json_object("props", "$.k").alias("request"), (F.col("value") > 10).alias("ok"), F.struct("ts", "event_id").alias("attempt"))
    return C.attempt_rollup(a, ["event_type"])


@query("g05_run_status", "SELECT user_id AS run, count(*) AS requested, count(*) FILTER (WHERE event_type = 'purchase' AND value > 40) AS succeeded, CASE WHEN count(*) FILTER (WHERE event_type = 'purchase' AND value > 40) = 0 THEN 'failed' ELSE 'success' END AS status FROM events GROUP BY 1")
def g05(spark, d):
    return C.run_status(events(spark, d).select(F.col("user_id").alias("run"), ((F.col("event_type") == "purchase") & (F.col("value") > 40)).alias("successful")), "run")


@query("g21_scope_accounting", "WITH s AS (SELECT user_id AS run_id, count(*) AS n, count(DISTINCT json_extract_string(props, '$.k')) AS k, count(*) FILTER (WHERE event_type = 'error') AS f FROM events GROUP BY 1), p AS (SELECT run_id, CASE WHEN n <> k THEN 'duplicate_scope' WHEN k < 60 THEN 'missing_scope' WHEN f <> 12 THEN 'failed_mismatch' END AS problem FROM s) SELECT run_id, problem FROM p WHERE problem IS NOT NULL")
def g21(spark, d):
    e = events(spark, d).select(F.col("user_id").alias("run_id"), F.get_json_object("props", "$.k").alias("scope"), (F.col("event_type") == "error").cast("int").alias("failed"))
    runs = e.select("run_id").distinct().withColumns({"requested": F.lit(60), "failed_total": F.lit(12)})
    return C.scope_accounting(e, runs)


# --- freshness ---------------------------------------------------------------------------------------------------------------------


def job_sources(spark, d):
    """Jobs are users; their sources are the event types, seen at the latest event, active unless the value was low."""
    e = events(spark, d).where("user_id % 3 <> 0 OR event_type <> 'view'")
    return e.groupBy(F.col("user_id").alias("job_id"), F.col("event_type").alias("source_name")).agg(F.max("ts").alias("last_seen_at"), F.max_by(F.col("value") > 8, F.struct("ts", "event_id")).alias("is_active"))


JS = "js AS (SELECT user_id AS job_id, event_type AS source_name, max(ts) AS seen, arg_max(value > 8, (ts, event_id)) AS is_active FROM events WHERE user_id % 3 <> 0 OR event_type <> 'view' GROUP BY 1, 2)"
DIRECT = ["signup", "click", "error"]
COMP = "c AS (SELECT job_id, CASE WHEN bool_or(source_name IN ('signup', 'click')) AND bool_or(source_name NOT IN ('signup', 'click')) THEN 'direct_plus_aggregator' WHEN bool_or(source_name IN ('signup', 'click')) THEN 'direct_only' WHEN bool_or(source_name NOT IN ('view', 'purchase')) THEN 'other' WHEN count(DISTINCT source_name) = 2 THEN 'both_aggregators' WHEN bool_or(source_name = 'view') THEN 'a_only' ELSE 'b_only' END AS composition FROM js WHERE job_id % 4 <> 0 OR source_name IN ('view', 'purchase') GROUP BY 1)"


def composed(spark, d):
    s = job_sources(spark, d).where("job_id % 4 <> 0 OR source_name IN ('view', 'purchase')")
    return H.composition(s, "job_id", ["signup", "click"], "view", "purchase")


@query("g09_composition", f"WITH {JS}, {COMP} SELECT * FROM c")
def g09(spark, d):
    return composed(spark, d)


@query("g07_family_stats", f"WITH {JS} SELECT source_name, count(*) AS total, count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE NOT is_active) AS inactive, count(DISTINCT job_id) AS jobs, strftime(max(seen), '%Y-%m-%d %H:%M:%S') AS newest_seen, round(median(CASE WHEN is_active THEN (epoch_us({T_NOW}) - epoch_us(seen)) / 86400e6 END), 3) AS median_age_days FROM js GROUP BY 1")
def g07(spark, d):
    return H.family_stats(job_sources(spark, d), "job_id", now()).select("source_name", "total", "active", "inactive", "jobs", F.date_format("newest_seen", "yyyy-MM-dd HH:mm:ss").alias("newest_seen"), "median_age_days")


@query("g08_age_matrix", f"WITH {JS}, {COMP}, l AS (SELECT c.*, (SELECT max(seen) FROM js WHERE js.job_id = c.job_id AND is_active) AS last FROM c WHERE job_id % 5 <> 0) SELECT composition, count(*) AS active_jobs, " + ", ".join(f"count(*) FILTER (WHERE last IS NULL OR last < {T_NOW} - INTERVAL {h} HOUR) AS not_seen_{h}h" for h in H.WINDOWS) + " FROM l GROUP BY ROLLUP (composition)")
def g08(spark, d):
    jobs = composed(spark, d).withColumn("status", F.when(F.col("job_id") % 5 == 0, "inactive").otherwise("active"))
    return H.age_matrix(jobs, job_sources(spark, d), "job_id", now())


@query("w02_latest_runs", "SELECT source_name, id FROM (SELECT event_type AS source_name, event_id AS id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 3")
def w02(spark, d):
    runs = events(spark, d).select(F.col("event_type").alias("source_name"), F.col("event_id").alias("id"), F.col("ts").alias("started_at"))
    return H.latest_runs(runs, 3).select("source_name", "id")


@query("w03_failure_streak", "WITH l AS (SELECT user_id, max(ts) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY 1) SELECT e.user_id AS scope, count(*) FILTER (WHERE event_type = 'error' AND (ok IS NULL OR ts > ok)) AS streak, strftime(max(ok), '%Y-%m-%d %H:%M:%S') AS last_success, arg_max(value, ts) FILTER (WHERE event_type = 'error') AS last_error FROM events e JOIN l USING (user_id) GROUP BY 1")
def w03(spark, d):
    runs = events(spark, d).select(F.col("user_id").alias("scope"), F.col("event_id").alias("id"), F.col("ts").alias("started_at"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("error"))
    return H.failure_streak(runs, "scope").withColumn("last_success", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss"))


@query("h07_scope_history", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events), l AS (SELECT user_id, max(ts) FILTER (WHERE event_type <> 'error') AS ok FROM events GROUP BY 1), s AS (SELECT e.user_id, count(*) FILTER (WHERE event_type = 'error' AND (ok IS NULL OR ts > ok)) AS streak, strftime(max(ok), '%Y-%m-%d %H:%M:%S') AS last_success FROM events e JOIN l USING (user_id) GROUP BY 1) SELECT r.user_id AS scope, string_agg(event_type, ',' ORDER BY r) AS recent, min(streak) AS streak, min(last_success) AS last_success FROM r JOIN s USING (user_id) WHERE r <= 5 GROUP BY 1")
def h07(spark, d):
    runs = events(spark, d).select(F.col("user_id").alias("scope"), F.col("event_id").alias("id"), F.col("ts").alias("started_at"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("error"), "event_type")
    return H.scope_history(runs, "scope", "event_type").select("scope", F.array_join("recent", ",").alias("recent"), "streak", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss").alias("last_success"))


def policies(spark, d):
    c = table(spark, d, "customer")
    day = F.expr("make_interval(0, 0, 0, cast(c_custkey % 40 as int))")
    return c.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("scope"), F.lit("known_gap").alias("review_state"), (stamp("2024-01-01") + day).alias("reviewed_at"), (stamp("2024-01-16") + day).alias("review_expires_at"), F.lit(96).alias("recheck_hours"), (F.col("c_custkey") % 7).alias("native_total"))


POL = "pol AS (SELECT c_custkey AS scope, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 AS INT)) AS a, TIMESTAMP '2024-01-16' + to_days(CAST(c_custkey % 40 AS INT)) AS b, c_custkey % 7 AS native_total FROM customer WHERE c_mktsegment <> 'MACHINERY'), val AS (SELECT * FROM pol WHERE a <= TIMESTAMP '2024-01-31' AND TIMESTAMP '2024-01-31' < b)"


@query("j17_valid_review", f"WITH {POL} SELECT event_id, val.scope IS NOT NULL AS reviewed FROM events LEFT JOIN val ON user_id = scope")
def j17(spark, d):
    e = events(spark, d).withColumnRenamed("user_id", "scope")
    return H.with_valid_review(e, policies(spark, d), ["scope"], now()).select("event_id", F.col("review_state").isNotNull().alias("reviewed"))


@query("j18_proof_join", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag <> 'A' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT') AND (l_orderkey, l_suppkey % 5) IN (SELECT o_orderkey, o_custkey % 5 FROM orders WHERE o_totalprice > 1000)")
def j18(spark, d):
    s = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linestatus").alias("lifecycle_state"), (F.col("l_returnflag") != "A").alias("inventory_complete"), F.col("l_orderkey").alias("run_id"), F.lit("s").alias("source_name"), (F.col("l_suppkey") % 5).alias("scope"))
    o = table(spark, d, "orders")
    runs = o.select(F.col("o_orderkey").alias("id"), F.lit("s").alias("source_name"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"), (F.col("o_orderpriority") == "1-URGENT").alias("bounded"))
    scopes = o.select(F.col("o_orderkey").alias("run_id"), (F.col("o_custkey") % 5).alias("scope"), (F.col("o_totalprice") > 1000).alias("complete"), F.lit(True).alias("successful"))
    return H.proven(s, runs, scopes, "O").select("l_orderkey", "l_partkey", "l_suppkey")


@query("h02_complete_runs", "SELECT o_orderkey AS id, o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' AND coalesce(n = 4 AND c, false) AS full_complete FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, bool_and(l_returnflag <> 'R') AS c FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def h02(spark, d):
    runs = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("s").alias("source_name"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"), (F.col("o_orderpriority") == "1-URGENT").alias("bounded"), F.lit(4).alias("requested"))
    scopes = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), (F.col("l_returnflag") != "R").alias("complete"), F.lit(True).alias("successful"))
    return H.complete_runs(runs, scopes).select("id", "full_complete")


def classified(spark, d):
    s = job_sources(spark, d)
    k = F.col("job_id")
    s = s.withColumns({
        "is_direct": F.col("source_name").isin(*DIRECT), "proved_absent": k % 2 == 0, "proved_observed": k % 5 != 0, "suspended": (F.col("source_name") == "click") & (k % 7 == 0), "last_verified_at": F.when(k % 6 != 0, F.col("last_seen_at")),
    })
    s = s.where("job_id % 9 <> 1 OR (source_name IN ('signup', 'click', 'error') AND NOT is_active)")
    jobs = events(spark, d).select(F.col("user_id").alias("job_id")).distinct().withColumns({"status": F.when(k % 9 == 1, "inactive").otherwise("active"), "expires_at": F.when(k % 8 == 0, stamp("2024-01-15"))})
    return H.freshness_class(jobs, s, "job_id", now())


CLASS = f"""{JS}, s AS (SELECT *, source_name IN ('signup', 'click', 'error') AS d, job_id % 2 = 0 AS pa, job_id % 5 <> 0 AS po, source_name = 'click' AND job_id % 7 = 0 AS su, CASE WHEN job_id % 6 <> 0 THEN seen END AS ver FROM js WHERE job_id % 9 <> 1 OR (source_name IN ('signup', 'click', 'error') AND NOT is_active)),
f AS (SELECT job_id, count(*) AS n, count(*) FILTER (WHERE d AND NOT is_active AND pa) AS g, bool_or(d) AS dir, bool_or(d AND is_active) AS act, bool_or(NOT d) AS prov, bool_or(d AND is_active AND su) AS sus, bool_or(d AND is_active AND NOT su AND po AND seen >= {T_NOW} - INTERVAL 72 HOUR AND coalesce(ver >= {T_NOW} - INTERVAL 72 HOUR, false)) AS v, bool_or(d AND is_active AND coalesce(ver >= {T_NOW} - INTERVAL 72 HOUR, false)) AS rec, bool_or(d AND is_active AND po) AS pr, bool_or(is_active) AS aa FROM s GROUP BY 1),
j AS (SELECT DISTINCT user_id AS job_id, CASE WHEN user_id % 9 = 1 THEN 'inactive' ELSE 'active' END AS status, user_id % 8 = 0 AS exp FROM events),
x AS (SELECT j.*, f.* EXCLUDE (job_id), n IS NULL AS bare, coalesce(g = n AND status = 'inactive', false) AS closed, coalesce(v AND status = 'active', false) AS live FROM j LEFT JOIN f USING (job_id)),
h AS (SELECT job_id, CASE WHEN closed THEN 'CONFIRMED_INACTIVE' WHEN live THEN 'VERIFIED_ACTIVE' ELSE 'NEEDS_VERIFICATION' END AS freshness, CASE WHEN bare THEN ['no_sources'] WHEN closed THEN ['all_authoritative_sources_confirmed_absent'] WHEN live THEN list_filter(['recent_complete_native_scope_evidence', CASE WHEN exp THEN 'expiry_overridden_by_verified_native' END], lambda z: z IS NOT NULL) ELSE list_filter([CASE WHEN g > 0 AND prov AND NOT act THEN 'direct_withdrawn_but_aggregator_present' END, CASE WHEN sus THEN 'reviewed_native_scope_coverage_gap' END, CASE WHEN NOT dir THEN 'discovery_only' END, CASE WHEN act AND NOT rec THEN 'direct_evidence_stale' END, CASE WHEN act AND NOT pr THEN 'authoritative_completeness_unproven' END, CASE WHEN exp THEN 'expired_timestamp_unconfirmed' END, CASE WHEN status <> 'active' AND aa THEN 'canonical_source_activity_conflict' END, 'no_recent_native_verification'], lambda z: z IS NOT NULL) END AS reasons FROM x)"""


@query("h01_freshness_class", f"WITH {CLASS} SELECT job_id, freshness, array_to_string(reasons, ',') AS reasons FROM h")
def h01(spark, d):
    return classified(spark, d).select("job_id", "freshness", F.array_join("reasons", ",").alias("reasons"))


@query("g10_status_and_reasons", f"WITH {CLASS} SELECT 'class:' || freshness AS key, count(*) AS n FROM h GROUP BY 1 UNION ALL SELECT 'reason:' || r, count(*) FROM (SELECT unnest(reasons) AS r FROM h) GROUP BY 1")
def g10(spark, d):
    c = classified(spark, d)
    a = H.status_counts(c, "freshness").select(F.concat(F.lit("class:"), "freshness").alias("key"), "n")
    return a.unionByName(H.reason_counts(c).select(F.concat(F.lit("reason:"), "reason").alias("key"), "n"))


@query("h03_freshness_report", f"WITH {CLASS}, {COMP}, l AS (SELECT c.*, (SELECT max(seen) FROM js WHERE js.job_id = c.job_id AND is_active) AS last FROM c), a AS (SELECT composition, count(*) AS active_jobs, " + ", ".join(f"count(*) FILTER (WHERE last IS NULL OR last < {T_NOW} - INTERVAL {h} HOUR) AS not_seen_{h}h" for h in H.WINDOWS) + f""" FROM l GROUP BY ROLLUP (composition)), m AS (SELECT source_name, count(*) AS total, count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE NOT is_active) AS inactive, count(DISTINCT job_id) AS jobs FROM js GROUP BY 1)
SELECT 'class' AS section, freshness AS key, 'n' AS measure, CAST(count(*) AS DOUBLE) AS value FROM h GROUP BY 2 UNION ALL SELECT 'reason', r, 'n', count(*) FROM (SELECT unnest(reasons) AS r FROM h) GROUP BY 2
UNION ALL SELECT 'age', coalesce(composition, 'total'), name, value FROM (UNPIVOT a ON active_jobs, {', '.join(f'not_seen_{h}h' for h in H.WINDOWS)} INTO NAME name VALUE value)
UNION ALL SELECT 'family', source_name, name, value FROM (UNPIVOT m ON total, active, inactive, jobs INTO NAME name VALUE value)""")
def h03(spark, d):
    jobs = composed(spark, d).withColumn("status", F.lit("active"))
    return H.freshness_report(classified(spark, d), H.age_matrix(jobs, job_sources(spark, d), "job_id", now()), H.family_stats(job_sources(spark, d), "job_id", now()))


def run_history(spark, d):
    """Events as runs: each names one to three scopes, errors failed, some are bounded or report no lifecycle or no closures."""
    e, k = events(spark, d), F.col("event_id")
    runs = e.select(
        k.alias("id"), F.col("event_type").alias("source_name"), F.when(F.col("value") < 5, "failed").otherwise("success").alias("status"), (k % 5 == 0).alias("bounded"), F.lit(2).alias("requested"), F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_interval(mins=(k % 50).cast("int"))).alias("finished_at"), F.when(k % 4 != 0, k % 9).alias("deactivated"), F.when(k % 3 != 0, k % 7).alias("reactivated"), F.when(F.col("event_type") != "view", k % 3).alias("canonical_closed"),
    )
    scopes = e.select(k.alias("run_id"), F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))).alias("scope"), (F.col("user_id") % 4).alias("u")).select("run_id", "scope", (F.col("scope") != F.col("u")).alias("complete"), F.lit(True).alias("successful"))
    return runs, scopes


RUNS = f"""r AS (SELECT event_id AS id, event_type AS source_name, CASE WHEN value < 5 THEN 'failed' ELSE 'success' END AS status, event_id % 5 = 0 AS bounded, ts AS started_at, ts + to_minutes(CAST(event_id % 50 AS INT)) AS finished_at, CASE WHEN event_id % 4 <> 0 THEN event_id % 9 END AS deactivated, CASE WHEN event_id % 3 <> 0 THEN event_id % 7 ELSE 0 END AS reactivated, CASE WHEN event_type <> 'view' THEN event_id % 3 END AS canonical_closed, event_id % 3 + 1 - CASE WHEN user_id % 4 <= event_id % 3 THEN 1 ELSE 0 END AS checked FROM events),
rl AS (SELECT * FROM r WHERE started_at >= {T_NOW} - INTERVAL 7 DAY AND deactivated IS NOT NULL),
dv AS (SELECT source_name, CASE WHEN source_name IN ('click', 'error') THEN 'heavy' ELSE 'light' END AS class, arg_max(id, (started_at, id)) FILTER (full_complete) AS complete_run, arg_max(finished_at, (started_at, id)) FILTER (full_complete) AS complete_finished_at, arg_max(id, (started_at, id)) FILTER (sure) AS verified_run, arg_max(finished_at, (started_at, id)) FILTER (sure) AS verified_finished_at, coalesce(arg_max(checked, (started_at, id)) FILTER (sure), 0) AS verified_scopes
FROM (SELECT *, status = 'success' AND NOT bounded AND id % 3 = 1 AND checked = 2 AS full_complete, status = 'success' AND checked > 0 AND NOT (bounded AND source_name IN ('click', 'error')) AS sure FROM r WHERE source_name IN ('signup', 'click', 'error')) GROUP BY 1, 2),
hi AS (SELECT event_type AS source_name, value > 8 AS on_, ts, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, value > 8) AS until FROM events),
ad AS (SELECT source_name, k AS days_ago, count(*) AS active FROM hi, range(7) t(k) WHERE on_ AND ts <= {T_NOW} - to_days(CAST(k AS INT)) AND (until IS NULL OR {T_NOW} - to_days(CAST(k AS INT)) < until) GROUP BY 1, 2),
ch AS (SELECT source_name, CAST(floor((epoch_us({T_NOW}) - epoch_us(started_at)) / 86400e6) AS BIGINT) AS days_ago, count(*) AS runs, sum(deactivated) AS deactivated, sum(reactivated) AS reactivated FROM rl GROUP BY 1, 2),
bd AS (SELECT source_name, days_ago, coalesce(active, 0) AS active, coalesce(runs, 0) AS runs, CAST(coalesce(deactivated, 0) AS BIGINT) AS deactivated, CAST(coalesce(reactivated, 0) AS BIGINT) AS reactivated FROM ad FULL JOIN ch USING (source_name, days_ago))"""


def report_parts(spark, d):
    runs, scopes = run_history(spark, d)
    states = events(spark, d).select("user_id", F.col("event_type").alias("source_name"), (F.col("value") > 8).alias("is_active"), F.col("ts").alias("at"))
    recent = H.recent_lifecycle(runs, scopes, now())
    days = H.lifecycle_by_day(recent, H.active_by_day(states, ["user_id", "source_name"], now()), now())
    return H.direct_verification(runs, scopes, ["signup", "click", "error"], ["click", "error"]), recent, days


@query("h03_direct_verification", f"WITH {RUNS} SELECT source_name, class, complete_run, epoch_us(complete_finished_at) AS complete_finished, verified_run, epoch_us(verified_finished_at) AS verified_finished, verified_scopes FROM dv")
def h03_direct(spark, d):
    v, _, _ = report_parts(spark, d)
    return v.select("source_name", "class", "complete_run", F.unix_micros("complete_finished_at").alias("complete_finished"), "verified_run", F.unix_micros("verified_finished_at").alias("verified_finished"), "verified_scopes")


@query("h03_recent_lifecycle", f"WITH {RUNS} SELECT source_name, id, checked AS complete_scopes, deactivated, reactivated, canonical_closed FROM rl")
def h03_recent(spark, d):
    return report_parts(spark, d)[1].select("source_name", "id", "complete_scopes", "deactivated", "reactivated", "canonical_closed")


@query("h03_lifecycle_by_day", f"WITH {RUNS} SELECT * FROM bd")
def h03_days(spark, d):
    return report_parts(spark, d)[2]


@query(
    "h03_whole_report",
    f"""WITH {CLASS}, {COMP}, {RUNS}, t AS (SELECT count(*) AS runs, coalesce(sum(deactivated), 0) AS deactivated, coalesce(sum(reactivated), 0) AS reactivated, CASE WHEN count(*) = count(canonical_closed) THEN sum(canonical_closed) END AS canonical_closed FROM rl)
SELECT 'class' AS section, freshness AS key, 'n' AS measure, CAST(count(*) AS DOUBLE) AS value FROM h GROUP BY 2 UNION ALL SELECT 'reason', r, 'n', count(*) FROM (SELECT unnest(reasons) AS r FROM h) GROUP BY 2
UNION ALL SELECT 'age', coalesce(composition, 'total'), 'active_jobs', count(*) FROM c GROUP BY ROLLUP (composition)
UNION ALL SELECT 'family', source_name, 'total', count(*) FROM js GROUP BY 2
UNION ALL SELECT 'direct', source_name, m, v FROM (SELECT source_name, unnest(['complete_finished_at', 'verified_finished_at', 'verified_scopes']) AS m, unnest([floor(epoch(complete_finished_at)), floor(epoch(verified_finished_at)), verified_scopes]) AS v FROM dv)
UNION ALL SELECT 'lifecycle', 'last_days', unnest(['runs', 'deactivated', 'reactivated', 'canonical_closed']), unnest([runs, deactivated, reactivated, canonical_closed]) FROM t
UNION ALL SELECT 'day', source_name || ':' || days_ago, unnest(['active', 'runs', 'deactivated', 'reactivated']), unnest([active, runs, deactivated, reactivated]) FROM bd""",
)
def h03_whole(spark, d):
    """The report with verification and lifecycle; of ages and families one measure each."""
    v, recent, days = report_parts(spark, d)
    jobs = composed(spark, d).withColumn("status", F.lit("active"))
    out = H.freshness_report(classified(spark, d), H.age_matrix(jobs, job_sources(spark, d), "job_id", now()), H.family_stats(job_sources(spark, d), "job_id", now()), v, H.lifecycle_totals(recent), days)
    return out.where("section NOT IN ('age', 'family') OR measure IN ('active_jobs', 'total')")


def scope_rows(spark, d):
    e = events(spark, d)
    k, few = F.col("scope"), lambda cond: F.count_if(F.expr(cond))
    rows = e.groupBy(F.col("user_id").alias("scope")).agg(few("event_type = 'error'").alias("n_error"), few("value < 0.2").alias("identity_unknown"), few("value > 250").alias("required_failures"))
    return rows.select(
        "scope", F.concat(F.lit("s"), k % 20).alias("source_name"), (k % 3 != 0).alias("ok"), F.when(k % 11 != 0, k % 5 != 0).alias("successful"), (k % 7 != 0).alias("complete"), (k % 2 == 0).alias("transient"),
        F.when(k % 4 == 0, "HTTP 410").otherwise("HTTP 500").alias("error"), (k % 6).cast("string").alias("signature"), "identity_unknown", F.lit(0).alias("unclassified"), "required_failures", F.lit(0).alias("fetch_failures"),
        (k % 13 == 0).alias("systemic"), F.when(k % 2 == 0, k % 10 != 0).alias("manifest_complete"),
    )


def scope_policies(spark, d):
    k = F.col("scope")
    state = F.when(k % 4 == 1, "HEALTHY").when(k % 4 == 2, "NEEDS_REVIEW").otherwise("KNOWN_GAP")
    return policies(spark, d).drop("review_state").withColumns({"review_state": state, "expected_error": F.when(k % 4 == 0, "HTTP 410"), "expected_signature": (k % 12).cast("string")})


SCOPE = f"""{POL}, r AS (SELECT user_id AS scope, 's' || (user_id % 20) AS source_name, user_id % 3 <> 0 AS ok, CASE WHEN user_id % 11 <> 0 THEN user_id % 5 <> 0 END AS suc, user_id % 7 <> 0 AS com, user_id % 2 = 0 AS tra, CASE WHEN user_id % 4 = 0 THEN 'HTTP 410' ELSE 'HTTP 500' END AS err, user_id % 6 AS sig, count(*) FILTER (WHERE value < 0.2) AS u, count(*) FILTER (WHERE value > 250) AS req, user_id % 13 = 0 AS sys, CASE WHEN user_id % 2 = 0 THEN user_id % 10 <> 0 END AS man FROM events GROUP BY 1),
v AS (SELECT r.*, CASE WHEN pol.scope IS NULL THEN NULL WHEN r.scope % 4 = 1 THEN 'HEALTHY' WHEN r.scope % 4 = 2 THEN 'NEEDS_REVIEW' ELSE 'KNOWN_GAP' END AS rev, coalesce(a <= {T_NOW} AND {T_NOW} < b, false) AS valid, ok AND coalesce(suc, false) AND com AS done, u > 0 OR req > 0 OR sys AS q FROM r LEFT JOIN pol USING (scope)),
w AS (SELECT *, valid AND CASE WHEN scope % 4 = 0 THEN err = 'HTTP 410' ELSE sig = scope % 12 END AS mat, CASE WHEN man IS NOT NULL THEN NOT man OR sys ELSE q END AS blk, coalesce(rev = 'NEEDS_REVIEW', false) AS qua, done AND rev IS NOT NULL AND rev <> 'HEALTHY' AS con, ok AND suc IS NULL AS unp FROM v),
cs AS (SELECT scope, source_name, CASE WHEN qua OR mat THEN rev WHEN ok THEN 'HEALTHY' WHEN tra THEN 'TRANSIENT_FAILURE' ELSE 'NEEDS_REVIEW' END AS state, CASE WHEN done AND q AND blk THEN 'INCOMPLETE' WHEN unp THEN 'UNKNOWN' WHEN ok AND NOT suc THEN 'INCOMPLETE' WHEN con THEN 'INCOMPLETE' WHEN done THEN 'AUTHORITATIVE_COMPLETE' WHEN mat AND ok THEN 'NON_AUTHORITATIVE_EXPECTED' WHEN NOT ok THEN 'UNAVAILABLE' ELSE 'INCOMPLETE' END AS coverage, done AND NOT blk AND NOT qua AS eligible, done,
list_filter([CASE WHEN rev IS NOT NULL AND NOT valid THEN 'review_expired_or_not_yet_effective' END, CASE WHEN valid AND scope % 4 = 0 AND ok THEN 'reviewed_exception_changed_behavior_requires_review' END, CASE WHEN con THEN 'reviewed_non_authoritative_scope_claimed_complete' END, CASE WHEN NOT done AND NOT mat AND ok THEN 'unexpected_coverage_gap' END, CASE WHEN NOT done AND NOT mat AND NOT ok THEN 'unexpected_acquisition_failure' END, CASE WHEN unp THEN 'missing_lifecycle_scope_evidence' END, CASE WHEN ok AND NOT unp AND NOT suc THEN 'acquisition_inventory_status_mismatch' END, CASE WHEN q THEN 'record_quality_requires_review' END, CASE WHEN done AND u > 0 THEN 'identity_coverage_requires_downgrade' END, CASE WHEN sys THEN 'systemic_record_failure' END], lambda z: z IS NOT NULL) AS alerts, mat AND NOT done AS g FROM w)"""


@query("h04_classify_scopes", f"WITH {SCOPE} SELECT scope, state, coverage, eligible, array_to_string(alerts, ',') AS alerts, g AND coverage IN ('NON_AUTHORITATIVE_EXPECTED', 'UNAVAILABLE') AS known_gap FROM cs")
def h04(spark, d):
    return H.classify_scopes(scope_rows(spark, d), scope_policies(spark, d), now()).select("scope", "state", "coverage", "eligible", F.array_join("alerts", ",").alias("alerts"), "known_gap")


@query("h05_evaluate_source", f"""WITH {SCOPE}, n AS (SELECT source_name, count(*) AS scopes, count(*) FILTER (WHERE eligible) AS eligible, count(*) FILTER (WHERE g AND coverage IN ('NON_AUTHORITATIVE_EXPECTED', 'UNAVAILABLE')) AS gaps, count(*) FILTER (WHERE state = 'NEEDS_REVIEW') AS to_review, count(*) FILTER (WHERE len(alerts) > 0 OR (done AND NOT eligible)) AS alerted FROM cs GROUP BY 1),
runs AS (SELECT source_name, CASE WHEN length(source_name) = 3 THEN 'failed' ELSE 'success' END AS status, scopes + CASE WHEN source_name = 's1' THEN 1 ELSE 0 END AS requested FROM n)
SELECT n.*, scopes = requested AS accounted, CASE WHEN status = 'failed' AND NOT (gaps = scopes AND scopes = requested AND alerted = 0) THEN 'FAILED' WHEN scopes <> requested OR alerted > 0 THEN 'PARTIAL' WHEN gaps > 0 THEN 'SUCCESS_WITH_KNOWN_GAPS' ELSE 'SUCCESS' END AS outcome FROM n JOIN runs USING (source_name)""")
def h05(spark, d):
    rows = scope_rows(spark, d)
    runs = rows.groupBy("source_name").agg(F.count("*").alias("n")).select("source_name", F.when(F.length("source_name") == 3, "failed").otherwise("success").alias("status"), (F.col("n") + F.when(F.col("source_name") == "s1", 1).otherwise(0)).alias("requested"))
    return H.evaluate_source(H.classify_scopes(rows, scope_policies(spark, d), now()), runs)


@query("h06_backlog_review", f"WITH {POL} SELECT f.scope, f.native_total, val.scope IS NOT NULL AS reviewed FROM (SELECT c_custkey AS scope, c_custkey % 14 AS native_total FROM customer) f LEFT JOIN val ON f.scope = val.scope AND f.native_total = val.native_total")
def h06(spark, d):
    found = table(spark, d, "customer").select(F.col("c_custkey").alias("scope"), (F.col("c_custkey") % 14).alias("native_total"))
    return H.backlog_review(found, policies(spark, d), now())


@query("h08_probe_decisions", f"WITH {POL}, l AS (SELECT user_id, max(ts) AS p FROM events WHERE event_type = 'signup' AND user_id % 3 <> 0 GROUP BY 1) SELECT scope, coalesce(p + INTERVAL 96 HOUR <= {T_NOW}, true) AS due, strftime(p + INTERVAL 96 HOUR, '%Y-%m-%d %H:%M:%S') AS next_probe_at, b < {T_NOW} AS review_expired FROM pol LEFT JOIN l ON user_id = scope")
def h08(spark, d):
    probes = events(spark, d).where("event_type = 'signup' AND user_id % 3 <> 0").select(F.col("user_id").alias("scope"), F.col("ts").alias("probed_at"))
    return H.probe_decisions(policies(spark, d), probes, "scope", now()).withColumn("next_probe_at", F.date_format("next_probe_at", "yyyy-MM-dd HH:mm:ss"))


@query("h09_accepted_gaps", f"WITH {POL} SELECT event_id FROM events WHERE event_type = 'error' AND ts >= {T_NOW} - INTERVAL 72 HOUR AND value > 5 AND user_id IN (SELECT scope FROM val)")
def h09(spark, d):
    health = events(spark, d).select("event_id", F.col("user_id").alias("scope"), F.col("ts").alias("checked_at"), (F.col("event_type") != "error").alias("ok"), F.when(F.col("value") > 5, 0).otherwise(1).alias("deactivated"), F.lit(0).alias("reactivated"))
    return H.accepted_gaps(health, policies(spark, d), "scope", now()).select("event_id")


def day_scopes(spark, d):
    """A run is a source and a request on a day; its scopes are users."""
    e = events(spark, d).withColumns({"day": F.date_format("ts", "yyyy-MM-dd"), "request": F.col("user_id") % 10})
    rows = e.groupBy(F.col("event_type").alias("source"), "request", "day", F.col("user_id").alias("scope")).agg(F.count("*").alias("n"), F.min("value").alias("low"))
    ok = F.col("low") > 0.3
    return rows.select("source", "request", "day", "scope", "n", ok.alias("successful"), (ok & (F.col("scope") % 97 != 0)).alias("complete"), F.when(ok & (F.col("scope") % 97 != 0), F.col("scope") % 2).otherwise(F.when(F.col("scope") % 193 == 0, 1).otherwise(0)).alias("deactivated"))


def day_runs(spark, d):
    runs = day_scopes(spark, d).groupBy("source", "request", "day").agg(F.count("*").alias("requested"), F.sum("n").alias("fetched"), F.sum("deactivated").alias("deactivated"), F.count_if(~F.col("complete")).alias("gaps"))
    k = F.col("request")
    return runs.withColumns({"run_id": F.when(k != 9, F.concat_ws(":", "source", "request", "day")), "status": F.when((k == 8) & (F.col("source") == "click"), "failed").otherwise("success"), "failed_records": F.when(k == 7, 1).otherwise(0), "gaps": F.when(k < 5, F.col("gaps")).otherwise(0)})


DAYS = """ds AS (SELECT event_type AS source, user_id % 10 AS request, strftime(ts, '%Y-%m-%d') AS day, user_id AS scope, count(*) AS n, min(value) > 0.3 AS suc FROM events GROUP BY 1, 2, 3, 4),
sc AS (SELECT *, suc AND scope % 97 <> 0 AS com, CASE WHEN suc AND scope % 97 <> 0 THEN scope % 2 WHEN scope % 193 = 0 THEN 1 ELSE 0 END AS dea FROM ds),
dr AS (SELECT source, request, day, count(*) AS requested, CAST(sum(n) AS BIGINT) AS fetched, CASE WHEN request < 5 THEN count(*) FILTER (WHERE NOT com) ELSE 0 END AS gaps, count(*) FILTER (WHERE suc) AS successful, count(*) FILTER (WHERE com) AS complete, bool_or(dea > 0 AND NOT com) AS unsafe, request = 8 AND source = 'click' AS failed, request = 7 AS lost FROM sc GROUP BY 1, 2, 3),
base AS (SELECT source, request, arg_max(fetched, day) AS base, arg_max(gaps, day) AS bgaps FROM dr WHERE day < '2024-01-30' GROUP BY 1, 2),
res AS (SELECT dr.*, base, bgaps FROM dr LEFT JOIN base USING (source, request) WHERE day = '2024-01-30' AND request <> 9 AND NOT unsafe),
an AS (SELECT *, list_filter([CASE WHEN complete = 0 AND requested <> gaps THEN 'no_authoritative_complete_scopes' END, CASE WHEN bgaps = gaps AND base > 0 AND fetched > 0 AND fetched < base * 0.9 THEN 'unexpected_result_collapse' END], lambda z: z IS NOT NULL) AS anomalies FROM res),
oc AS (SELECT source, request, fetched AS observed, gaps, CASE WHEN base IS NULL THEN 'unavailable' WHEN bgaps <> gaps THEN 'not_comparable_coverage_changed' ELSE 'comparable' END AS volume, array_to_string(anomalies, ',') AS anomalies, CASE WHEN failed OR (successful = 0 AND requested <> gaps) THEN 'FAILED' WHEN complete + gaps <> requested OR lost OR len(anomalies) > 0 THEN 'PARTIAL' WHEN gaps > 0 THEN 'SUCCESS_WITH_KNOWN_GAPS' ELSE 'SUCCESS' END AS status FROM an)"""
ON = ["source", "request"]


def outcomes(spark, d):
    runs, last = day_runs(spark, d), "day = '2024-01-30'"
    base = H.baseline_from_runs(runs.where("day < '2024-01-30'").withColumns({"started_at": F.col("day"), "id": F.lit(0), "ok": F.lit(True), "observed": F.col("fetched")}), ON)
    return H.normalize_outcome(runs.where(last), day_scopes(spark, d).where(last), base, ON, 0.9), base


@query("h10_normalize_outcome", f"WITH {DAYS} SELECT * FROM oc")
def h10(spark, d):
    return outcomes(spark, d)[0].withColumn("anomalies", F.array_join("anomalies", ","))


@query("h10_check_outcomes", f"WITH {DAYS} SELECT source, request, CASE WHEN request = 9 THEN 'malformed_outcome' ELSE 'unsafe_lifecycle_outcome' END AS problem FROM dr WHERE day = '2024-01-30' AND (request = 9 OR unsafe)")
def h10_checks(spark, d):
    last = "day = '2024-01-30'"
    return H.check_outcomes(day_runs(spark, d).where(last), day_scopes(spark, d).where(last), ON)


@query("h11_next_baseline", f"WITH {DAYS}, h AS (SELECT source, request, observed, gaps FROM oc WHERE status LIKE 'SUCCESS%') SELECT * FROM h UNION ALL SELECT source, request, base, bgaps FROM base WHERE (source, request) NOT IN (SELECT source, request FROM h)")
def h11(spark, d):
    out, base = outcomes(spark, d)
    return H.next_baseline(base, out, ON)


@query("h12_group_status", f"WITH {DAYS} SELECT source, CASE WHEN bool_and(status = 'SUCCESS') THEN 'SUCCESS' WHEN bool_and(status LIKE 'SUCCESS%') THEN 'SUCCESS_WITH_KNOWN_GAPS' WHEN bool_and(status = 'FAILED') THEN 'FAILED' ELSE 'PARTIAL' END AS group_status FROM oc GROUP BY 1")
def h12(spark, d):
    return H.group_status(outcomes(spark, d)[0], "source")


@query("t01_safe_order", "SELECT l_orderkey, l_partkey, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey) AS place FROM lineitem ORDER BY place LIMIT 50")
def t01(spark, d):
    from pyspark.sql import Window

    ties = ("l_orderkey", "l_partkey", "l_suppkey")
    top = L.safe_order(table(spark, d, "lineitem"), "l_extendedprice", *ties).limit(50)
    return top.select("l_orderkey", "l_partkey", F.row_number().over(Window.orderBy(F.desc("l_extendedprice"), *ties)).alias("place"))


@query("t02_select_scopes", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 AND s_nationkey IN (1, 2, 4, 5, 7) ORDER BY s_nationkey, s_suppkey LIMIT 20")
def t02(spark, d):
    return SN.select_scopes(table(spark, d, "supplier"), ["s_nationkey", "s_suppkey"], F.col("s_acctbal") > 0, 20, s_nationkey=[1, 2, 4, 5, 7]).select("s_suppkey", "s_name")