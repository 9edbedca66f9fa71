"""Queries of feed ingest and of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import maintenance as M
from tablewright.operators.ingest import FIELDS, State, ingest_feed
from tablewright.plans import table
from tablewright.plans.profiling import landed, landing_files
from tablewright.sources import landing as S
from tablewright.storage import scratch, spread
from tablewright.streaming import jobs as J

Q: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        Q[name] = (fn, sql)
        return fn

    return keep


def at(day: str):
    return F.lit(day).cast("timestamp")


def kind():
    return F.substring("o_orderpriority", 1, 1)


# --- one feed into a state ------------------------------------------------------------------------------------------------------------

def lever_batch(spark, d):
    """All orders as one feed; open orders of medium priority lie abroad."""
    abroad = (F.col("o_orderstatus") == "O") & (kind() == "3")
    return landed(spark, d, "lever_direct", {"country": F.when(abroad, "US").otherwise("CZ")})


def lever_state(spark, d):
    """Finished orders are known by the feed already, pending ones by another feed at the same address. Of the open ones, urgent ones are known by another feed at the
    board's own address, high ones as a job of their company with the same title, and those of no stated priority as two jobs at one address. Companies with even keys are known."""
    o = spread(table(spark, d, "orders")).withColumns({"k": F.col("o_orderkey").cast("string"), "p": kind()})
    none, before = F.lit(None).cast("string"), at("2024-01-01")
    status = F.col("o_orderstatus")
    letters = F.when(status.isin("F", "P"), F.array(F.lit("j"))).when(F.col("p") == "1", F.array(F.lit("i"))).when(F.col("p") == "2", F.array(F.lit("t"))).when(F.col("p") == "4", F.array(F.lit("a"), F.lit("b")))
    held = o.where(letters.isNotNull()).withColumn("letter", F.explode(letters)).withColumn("job_id", F.concat("letter", "k"))
    known = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).otherwise("other")
    values = {"title": F.when(F.col("letter") == "t", F.concat(F.lit("Job "), "k")).otherwise("old"), "company_id": F.when(F.col("letter") == "t", known)}
    jobs = held.select(F.col("job_id").alias("id"), *[values.get(f, none).alias(f) for f in FIELDS], F.lit("active").alias("status"), before.alias("last_seen_at"))
    url = F.when(F.col("letter") == "i", F.concat(F.lit("https://jobs.example.com/Scope/"), "k", F.lit("/apply"))).when(F.col("letter") == "t", F.concat(F.lit("https://else.example.com/"), "k")).otherwise(F.concat(F.lit("https://jobs.example.com/"), "k", F.lit("?from=else")))
    sources = held.select(
        F.when(status == "F", "lever_direct").otherwise("jooble_direct").alias("source_name"), F.concat(F.when(status == "F", "scope:").otherwise(F.col("letter")), "k").alias("source_job_id"), "job_id",
        url.alias("source_url"), none.alias("raw_payload"), F.lit(True).alias("is_active"), before.alias("last_seen_at"),
    )
    companies = o.where("o_custkey % 2 = 0").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id")).distinct().select("id", F.upper("id").alias("name"), before.alias("created_at"))
    return State(companies, jobs, sources)


LEVER = """o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS t, o_custkey AS c, o_orderstatus AS s, substr(o_orderpriority, 1, 1) AS p FROM orders),
x AS (SELECT *, CASE WHEN k % 9 = 0 THEN 'rejected: missing_title' WHEN s = 'O' AND p = '3' THEN 'skipped: foreign' WHEN s = 'F' THEN 'updated' WHEN s = 'P' OR p = '1' OR (p = '2' AND c % 2 = 0) THEN 'attached' ELSE 'created' END AS change FROM o)"""


@query(
    "r04_feed_ingest",
    f"WITH {LEVER} SELECT 'scope:' || t AS source_job_id, change, CASE change WHEN 'updated' THEN 'j' || t WHEN 'attached' THEN CASE WHEN s = 'P' THEN 'j' WHEN p = '1' THEN 'i' ELSE 't' END || t WHEN 'created' THEN sha256('lever_direct:scope:' || t) END AS job_id, CASE WHEN change = 'attached' THEN CASE WHEN s = 'P' THEN 'url' WHEN p = '1' THEN 'identity' ELSE 'title' END END AS evidence FROM x",
)
def r04(spark, d):
    """What became of each order: its job, and the evidence that it was attached by."""
    return ingest_feed(lever_batch(spark, d), lever_state(spark, d), "lever_direct", at("2024-01-31"), "run").rows.select("source_job_id", "change", "job_id", "evidence")


@query(
    "r04_feed_state",
    f"""WITH {LEVER}, j AS (SELECT *, CASE WHEN s IN ('F', 'P') THEN 'j' WHEN p = '1' THEN 'i' WHEN p = '2' THEN 't' END AS letter FROM x)
SELECT letter || t AS id, CASE WHEN change IN ('updated', 'attached') OR letter = 't' THEN 'Job ' || t ELSE 'old' END AS title, CASE WHEN change IN ('updated', 'attached') THEN CASE WHEN c % 2 = 0 THEN 'c' || c ELSE sha256('c' || c) END WHEN letter = 't' THEN CASE WHEN c % 2 = 0 THEN 'c' || c ELSE 'other' END END AS company_id FROM j WHERE letter IS NOT NULL
UNION ALL SELECT l || t, 'old', NULL FROM x, (VALUES ('a'), ('b')) v(l) WHERE s = 'O' AND p = '4'
UNION ALL SELECT sha256('lever_direct:scope:' || t), 'Job ' || t, CASE WHEN c % 2 = 0 THEN 'c' || c ELSE sha256('c' || c) END FROM x WHERE change = 'created'""",
)
def r04_state(spark, d):
    """The jobs after it."""
    return ingest_feed(lever_batch(spark, d), lever_state(spark, d), "lever_direct", at("2024-01-31"), "run").state.jobs.select("id", "title", "company_id")


UUID_SQL = "(substr(md5(t), 1, 8) || '-' || substr(md5(t), 9, 4) || '-' || substr(md5(t), 13, 4) || '-' || substr(md5(t), 17, 4) || '-' || substr(md5(t), 21, 12))"


@query(
    "r04_feed_ingest_uuid",
    f"""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, substr(o_orderpriority, 1, 1) AS p, CAST(o_orderkey AS VARCHAR) AS t FROM orders), x AS (SELECT *, {UUID_SQL} AS u FROM o),
y AS (SELECT *, CASE WHEN k % 9 = 0 THEN 'rejected: missing_title' WHEN p = '1' THEN 'skipped: unlisted' WHEN s = 'P' THEN 'attached' ELSE 'created' END AS change FROM x)
SELECT 'scope:' || u AS source_job_id, change, CASE change WHEN 'attached' THEN 'j' || t WHEN 'created' THEN sha256('ashby_direct:scope:' || u) END AS job_id, CASE WHEN change = 'attached' THEN 'uuid' END AS evidence FROM y""",
)
def r04_uuid(spark, d):
    """A feed whose ids are uuids: urgent orders are not listed, pending ones stand within another feed's address."""
    m = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    batch = landed(spark, d, "ashby_direct", {"id": uuid}, {"$.isListed": kind() != "1"})
    o, none = table(spark, d, "orders").where("o_orderstatus = 'P'").withColumn("job_id", F.concat(F.lit("j"), F.col("o_orderkey").cast("string"))), F.lit(None).cast("string")
    jobs = o.select(F.col("job_id").alias("id"), *[none.alias(f) for f in FIELDS], F.lit("active").alias("status"), at("2024-01-01").alias("last_seen_at"))
    url = F.concat(F.lit("https://else.example.com/x/"), F.upper(uuid), F.lit("/apply"))
    sources = o.select(F.lit("jooble_direct").alias("source_name"), "job_id", F.col("job_id").alias("source_job_id"), url.alias("source_url"), none.alias("raw_payload"), F.lit(True).alias("is_active"), at("2024-01-01").alias("last_seen_at"))
    companies = spark.createDataFrame([], "id string, name string, created_at timestamp")
    return ingest_feed(batch, State(companies, jobs, sources), "ashby_direct", at("2024-01-31"), "run").rows.select("source_job_id", "change", "job_id", "evidence")


# --- listings with details ------------------------------------------------------------------------------------------------------------


@query(
    "s03_listing_details",
    "SELECT CAST(o_orderkey AS VARCHAR) AS native_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Detail ' ELSE 'Listed ' END || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'Text ' || o_orderkey ELSE '' END AS description, CASE WHEN o_orderkey % 3 = 0 THEN '[{\"min_cents\":' || o_orderkey || '}]' END AS salary_text, CASE WHEN o_orderkey % 2 = 0 THEN 'First ' || o_orderkey ELSE 'Office' END AS place FROM orders",
)
def s03(spark, d):
    """A customer's orders as one board page; every third has a detail with a text and a pay range. The place is a second path's where the first is blank."""
    o = table(spark, d, "orders").withColumn("key", F.col("o_orderkey").cast("string"))
    even = F.col("o_orderkey") % 2 == 0
    offices = F.array(F.struct(F.lit("Office").alias("location")))
    record = F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("Listed "), "key").alias("title"), F.struct(F.when(even, F.concat(F.lit("First "), "key")).otherwise(" ").alias("name")).alias("location"), offices.alias("offices"))
    pages = o.groupBy(F.col("o_custkey").cast("string").alias("scope")).agg(F.to_json(F.struct(F.struct(F.count("*").alias("total")).alias("meta"), F.collect_list(record).alias("jobs"))).alias("body"))
    detail = F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("Detail "), "key").alias("title"), F.concat(F.lit("<p>Text "), "key", F.lit("</p>")).alias("content"), F.array(F.struct(F.col("o_orderkey").alias("min_cents"))).alias("pay_input_ranges"))
    details = o.where("o_orderkey % 3 = 0").select(F.col("o_custkey").cast("string").alias("scope"), F.to_json(detail).alias("body"))
    listed = S.listed_records(pages, "greenhouse_direct")
    out = S.project_with_details(listed, details, "greenhouse_direct")
    return out.select("native_id", "title", F.coalesce("description", F.lit("")).alias("description"), "salary_text", F.split_part("location_text", F.lit(","), F.lit(1)).alias("place"))


@query(
    "s07_listing_details",
    "SELECT 'R-' || o_orderkey AS native_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Detail ' ELSE 'Listed ' END || o_orderkey AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'hybrid' ELSE 'unknown' END AS remote_type, (SELECT count(*) FROM orders i WHERE i.o_custkey = orders.o_custkey) AS stated_total FROM orders",
)
def s07(spark, d):
    """The listing states its id among bullet fields, the detail as a requisition id."""
    o = table(spark, d, "orders").withColumn("key", F.col("o_orderkey").cast("string"))
    own = F.concat(F.lit("R-"), "key")
    record = F.struct(F.concat(F.lit("Listed "), "key").alias("title"), F.array(own).alias("bulletFields"))
    pages = o.groupBy(F.col("o_custkey").cast("string").alias("scope")).agg(F.to_json(F.struct(F.count("*").alias("total"), F.collect_list(record).alias("jobPostings"))).alias("body"))
    detail = F.struct(F.struct(own.alias("jobReqId"), F.concat(F.lit("Detail "), "key").alias("title"), F.lit("Hybrid").alias("remoteType")).alias("jobPostingInfo"))
    details = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").cast("string").alias("scope"), F.to_json(detail).alias("body"))
    listed = S.listed_records(pages, "workday_direct")
    out = S.project_with_details(listed, details, "workday_direct")
    return out.join(listed.select("scope", "stated_total").distinct(), "scope").select("native_id", "title", "remote_type", "stated_total")


# --- streams --------------------------------------------------------------------------------------------------------------------------


@query(
    "m01_feed_stream",
    "SELECT 'scope:' || o_orderkey AS source_job_id, sha256('lever_direct:scope:' || o_orderkey) AS job_id, 'Job ' || o_orderkey AS title, sha256('c' || o_custkey) AS company_id, 'active' AS status FROM orders WHERE o_orderkey % 100 <> 0 AND o_orderkey % 9 <> 0",
)
def m01_feed(spark, d):
    """The landed orders ingested by the stream, run to their end twice: sources with their jobs as the stores hold them."""
    store, out, checkpoint = (scratch(spark, n) for n in ("store", "changes", "progress"))
    landing = landing_files(spark, d)
    for _ in range(2):
        J.start_feed_stream(spark, landing, store, out, checkpoint, at("2024-01-31"), 8).awaitTermination()
    stores = J.Stores(spark, store, 8)
    jobs = stores.jobs.current().select(F.col("id").alias("job_id"), "title", "company_id", "status")
    return stores.sources.current().join(jobs, "job_id").select("source_job_id", "job_id", "title", "company_id", "status")


def source_rows(rows, key, job, payload):
    return rows.select(F.lit("s").alias("source_name"), key.cast("string").alias("source_job_id"), job.alias("job_id"), F.lit("u").alias("source_url"), F.lit(True).alias("is_active"), payload.alias("payload_hash"), "changed_at")


@query("m02_invalidation_stream", "SELECT DISTINCT o_orderkey AS job_id FROM orders WHERE o_orderstatus = 'P'")
def m02_stream(spark, d):
    """Source rows arrive again; those of pending orders with another payload."""
    o = table(spark, d, "orders").withColumn("changed_at", F.col("o_orderdate").cast("timestamp"))
    key = F.col("o_orderkey")
    store, changes, out, checkpoint = (scratch(spark, n) for n in ("snapshot", "changes", "stale", "progress"))
    held = J.invalidation_store(spark, store, "long", 8)
    held.replace(source_rows(o, key, key, F.lit("h")), 0)
    later = source_rows(o, key, key, F.when(F.col("o_orderstatus") == "P", "other").otherwise("h"))
    later.write.parquet(changes)
    J.start_invalidation_stream(spark, changes, later.schema, held, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("job_id").distinct()


@query(
    "m02_change_history",
    """WITH e AS (SELECT DISTINCT o_custkey AS k, o_orderstatus AS v, o_orderdate AS t FROM orders), s AS (SELECT k, v, lag(v) OVER (PARTITION BY k ORDER BY t, ascii(v) % 10, v) AS b FROM e),
m AS (SELECT k, v, b FROM s WHERE v IS DISTINCT FROM b), j AS (SELECT k * 10 + ascii(v) % 10 AS job_id FROM m UNION ALL SELECT k * 10 + ascii(b) % 10 FROM m WHERE ascii(b) % 10 <> ascii(v) % 10) SELECT job_id, count(*) AS changes FROM j GROUP BY 1""",
)
def m02_history(spark, d):
    """A customer's orders as events of one source that goes from state to state and from job to job, some back again, in two runs of the stream."""
    o = table(spark, d, "orders").withColumn("changed_at", F.col("o_orderdate").cast("timestamp"))
    job = F.col("o_custkey") * 10 + F.ascii("o_orderstatus") % 10
    events = source_rows(o, F.col("o_custkey"), job, F.col("o_orderstatus"))
    store, changes, out, checkpoint = (scratch(spark, n) for n in ("states", "changes", "stale", "progress"))
    held = J.invalidation_store(spark, store, "long", 8)
    for part in (F.col("changed_at") < at("1998-01-01"), F.col("changed_at") >= at("1998-01-01")):
        events.where(part).write.mode("append").parquet(changes)
        J.start_invalidation_stream(spark, changes, events.schema, held, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("job_id").agg(F.sum("changes").alias("changes"))


# --- profiles kept up to date ---------------------------------------------------------------------------------------------------------


def upkeep():
    fact = lambda rows, field, value, score: rows.select("doc_id", F.lit(field).alias("field"), value.alias("value"), F.lit(score).alias("score"), F.lit(True).alias("active"), F.concat_ws(":", F.lit(field), "doc_id").alias("evidence_id"))
    native = lambda rows: fact(rows, "lang", F.col("lang"), 50).unionByName(fact(rows, "source", F.col("source"), 50))
    text = lambda rows: fact(rows, "size", F.when(F.length("text") > 1500, "long").when(F.length("text") > 300, "short"), 30).unionByName(fact(rows, "source", F.when(F.contains("text", F.lit("!!")), "loud"), 50))
    return M.Upkeep("doc_id", ["lang", "source"], "text", "quality", ["lang", "source", "size"], native, text, {"rules": "1"})


def two_states(spark, d):
    """Documents, and the same after a change: some have another language, some a longer text, some are gone, some are named as changed though nothing did."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text", F.lit("complete").alias("quality"))
    k = F.col("doc_id") % 10
    later = docs.where(k != 2).withColumns({"lang": F.when(k == 0, "xx").otherwise(F.col("lang")), "text": F.when(k == 1, F.concat("text", F.lit(" more!!"), F.repeat(F.lit(" and more"), 200))).otherwise(F.col("text"))})
    return docs, later, docs.where(k <= 3).select("doc_id")


def maintained(spark, d):
    docs, later, stale = two_states(spark, d)
    how = upkeep()
    first, _ = M.maintain(M.empty_state(docs, how), docs, docs, how, at("2024-01-01"))
    return M.maintain(first, later, stale, how, at("2024-01-02"))


LATER = "l AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'xx' ELSE lang END AS lang, source, CASE WHEN doc_id % 10 = 1 THEN text || ' more!!' || repeat(' and more', 200) ELSE text END AS text FROM documents WHERE doc_id % 10 <> 2)"


@query(
    "r09_r10_maintained_profiles",
    f"WITH {LATER}, v AS (SELECT doc_id, CASE WHEN doc_id % 10 IN (0, 1) THEN 2 ELSE 1 END AS versions FROM l) SELECT doc_id, CASE WHEN lang IS NULL THEN 'not_mentioned' ELSE 'known' END AS lang_state, lang AS lang_value, CASE WHEN contains(text, '!!') THEN 'conflict' ELSE 'known' END AS source_state, CASE WHEN NOT contains(text, '!!') THEN source END AS source_value, CASE WHEN length(text) > 1500 THEN 'long' WHEN length(text) > 300 THEN 'short' END AS size_value, versions FROM l JOIN v USING (doc_id)",
)
def r09_r10(spark, d):
    """Profiles after a change that was followed, with the number of versions that each job has."""
    state, _ = maintained(spark, d)
    n = state.versions.groupBy("doc_id").agg(F.count("*").alias("versions"))
    out = M.current_profiles(state, "doc_id").join(n, "doc_id")
    return out.select("doc_id", F.col("profile.lang.state").alias("lang_state"), F.col("profile.lang.value").alias("lang_value"), F.col("profile.source.state").alias("source_state"), F.col("profile.source.value").alias("source_value"), F.col("profile.size.value").alias("size_value"), "versions")


@query(
    "r09_r10_work",
    "WITH n AS (SELECT count(*) FILTER (doc_id % 10 = 0) AS a, count(*) FILTER (doc_id % 10 = 1) AS b, count(*) FILTER (doc_id % 10 = 2) AS c, count(*) FILTER (doc_id % 10 <= 3) AS every FROM documents) SELECT unnest(['native', 'text', 'selection', 'profile', 'gone', 'asked']) AS layer, unnest([a, b, a + b, a + b, c, every]) AS n FROM n",
)
def r09_r10_work(spark, d):
    """The rows that each layer ran on for it."""
    return maintained(spark, d)[1]
