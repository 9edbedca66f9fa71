"""Queries of the linkage operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.operators import linkage as L
from tablewright.plans import table
from tablewright.plans.scalars import NORM, SIM, TRI, URL

Q: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        Q[name] = (fn, sql)
        return fn

    return keep


@query("j01_existing_source", "SELECT o_orderkey, k.job AS job FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS job FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) k ON o_orderkey = l_orderkey")
def j01(spark, d):
    batch = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("key"), F.lit(1).alias("line"))
    sources = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("job"))
    return L.existing_source(batch, sources, ["key", "line"], "job").select("o_orderkey", "job")


@query("j02_unique_match", "SELECT p_name, p_brand, p_size, CASE WHEN count(*) = 1 THEN min(p_partkey) END AS target, count(*) > 1 AS ambiguous FROM part GROUP BY 1, 2, 3")
def j02(spark, d):
    p = table(spark, d, "part").withColumn("probe", F.struct("p_name", "p_brand", "p_size"))
    return L.unique_match(p.select("probe", F.col("p_partkey").alias("target")), "probe", "target").select("probe.*", "target", "ambiguous")


@query("j03_attach_by_url", f"WITH k AS (SELECT page_id, {URL.format('url')} AS u FROM pages) SELECT a.page_id AS probe, CASE WHEN count(DISTINCT b.page_id) = 1 THEN min(b.page_id) END AS target, count(DISTINCT b.page_id) > 1 AS ambiguous FROM k a JOIN k b ON a.u = b.u GROUP BY a.page_id")
def j03(spark, d):
    p = table(spark, d, "pages")
    batch = p.select(F.col("page_id").alias("probe"), F.concat(F.split_part("url", F.lit("#"), F.lit(1)), F.lit("#apply")).alias("link"))
    return L.attach_by_url(batch, "probe", "link", p.select(F.col("page_id").alias("target"), "url", F.upper("url").alias("canonical")), "target", ["url", "canonical"]).select("probe", "target", "ambiguous")


@query(
    "j04_attach_by_evidence",
    "WITH e AS (SELECT a.o_orderkey AS probe, b.o_orderkey AS target FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate UNION SELECT a.o_orderkey, b.o_orderkey FROM orders a JOIN orders b ON a.o_totalprice = b.o_totalprice) SELECT probe, CASE WHEN count(DISTINCT target) = 1 THEN min(target) END AS target, count(DISTINCT target) > 1 AS ambiguous FROM e GROUP BY probe",
)
def j04(spark, d):
    o = table(spark, d, "orders")
    by = lambda *on: L.evidence_by(o.select(F.col("o_orderkey").alias("probe"), *on), "probe", o.select(F.col("o_orderkey").alias("target"), *on), "target", list(on))
    return L.attach(o.select(F.col("o_orderkey").alias("probe")), [by("o_custkey", "o_orderdate"), by("o_totalprice")], "probe", "target").select("probe", "target", "ambiguous")


MD = "substr(md5(CAST(page_id % 200 AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(page_id % 200 AS VARCHAR)), 9, 4) || '-' || substr(md5(CAST(page_id % 200 AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(page_id % 200 AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(page_id % 200 AS VARCHAR)), 21, 12)"


@query("j05_attach_by_uuid", f"WITH k AS (SELECT page_id, {MD} AS u FROM pages) SELECT a.page_id AS probe, CASE WHEN count(*) = 1 THEN min(b.page_id) END AS target FROM k a JOIN k b USING (u) GROUP BY 1")
def j05(spark, d):
    m = F.md5((F.col("page_id") % 200).cast("string").cast("binary"))
    p = table(spark, d, "pages").withColumn("uuid", F.concat_ws("-", *[F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
    sources = p.select(F.col("page_id").alias("target"), F.concat(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("/"), F.upper("uuid"), F.lit("/apply")).alias("url"))
    return L.attach_by_uuid(p.select(F.col("page_id").alias("probe"), "uuid"), "probe", "uuid", sources, "target", "url").select("probe", "target")


@query("j06_attach_by_identity", "SELECT o_orderkey AS probe, CASE WHEN lo = hi THEN lo END AS target FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY 1) k ON o_orderkey = l_orderkey")
def j06(spark, d):
    own = F.col("l_orderkey").cast("string")
    second = F.when(F.col("l_suppkey") % 3 == 0, F.lit("other")).when(F.col("l_suppkey") % 3 == 1, own)
    batch = table(spark, d, "orders").select(F.col("o_orderkey").alias("probe"), F.col("o_orderkey").cast("string").alias("identity"))
    return L.attach_by_identity(batch, "probe", "identity", table(spark, d, "lineitem").withColumnRenamed("l_partkey", "target"), "target", F.array(own, second)).select("probe", "target")


@query("j07_attach_by_host_set", "SELECT o_orderkey AS probe, CASE WHEN lo = hi THEN lo END AS target FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi FROM lineitem WHERE l_suppkey % 4 <> 0 GROUP BY 1) k ON o_orderkey = l_orderkey")
def j07(spark, d):
    host = F.when(F.col("l_suppkey") % 4 == 0, F.lit("evil.example")).otherwise(F.lit("b.example"))
    pair = lambda h: F.struct(h.alias("host"), F.col("l_orderkey").alias("id"))
    sources = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("target"), F.array(pair(F.lit("a.example")), pair(host)).alias("pairs"))
    batch = table(spark, d, "orders").select(F.col("o_orderkey").alias("probe"), F.col("o_orderkey").alias("own"))
    return L.attach_by_host_set(batch, "probe", "own", sources, "target", "pairs", ["a.example", "b.example"]).select("probe", "target")


@query("j08_attach_by_exact_title", "WITH a AS (SELECT p_brand, p_name, min(p_partkey) AS probe FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2 HAVING count(*) = 1), b AS (SELECT p_brand, p_name, min(p_partkey) AS target FROM part WHERE p_partkey % 2 = 1 GROUP BY 1, 2 HAVING count(*) = 1 AND max(p_size) >= 25) SELECT p_partkey AS probe, target FROM part LEFT JOIN (SELECT probe, target FROM a JOIN b USING (p_brand, p_name)) ON p_partkey = probe WHERE p_partkey % 2 = 0")
def j08(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand", T.exact_title_key(F.col("p_name")).alias("title"), (F.col("p_size") < 25).alias("taken"))
    batch, jobs = p.where("p_partkey % 2 = 0").select("p_brand", "title", F.col("p_partkey").alias("probe")), p.where("p_partkey % 2 = 1").select("p_brand", "title", "taken", F.col("p_partkey").alias("target"))
    return L.attach_by_exact_title(batch, jobs, ["p_brand", "title"], "probe", "target", "taken").select("probe", "target")


COMPANY = "trim(regexp_replace(trim(regexp_replace(lower(p_name || ' ' || p_brand || ' ' || p_size || CASE WHEN p_partkey % 2 = 0 THEN ' GmbH' ELSE '' END), '[^a-z0-9]+', ' ', 'g')), '\\s+(gmbh)$', ''))"


@query("j09_resolve_company", f"WITH k AS (SELECT p_partkey, p_type, p_retailprice, {COMPANY} AS company_key FROM part), c AS (SELECT company_key, CAST(p_partkey AS VARCHAR) AS id FROM (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY p_retailprice, p_partkey) AS r FROM k WHERE p_type IN ('LARGE', 'ECONOMY', 'SMALL')) WHERE r = 1) SELECT k.p_partkey, coalesce(c.id, sha256(k.company_key)) AS company_id FROM k LEFT JOIN c USING (company_key)")
def j09(spark, d):
    """Half of the part types are the companies that are known already; both sides grow with the table."""
    p = table(spark, d, "part").withColumn("name", F.concat_ws(" ", "p_name", "p_brand", "p_size", F.when(F.col("p_partkey") % 2 == 0, "GmbH")))
    companies = p.where(F.col("p_type").isin("LARGE", "ECONOMY", "SMALL")).select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), "name", F.col("p_retailprice").alias("created_at"))
    resolved, _ = L.resolve_company(p.select("p_partkey", "name"), "name", companies)
    return resolved.select("p_partkey", F.regexp_replace("company_id", "^0{1,8}(?=[0-9]{1,8}$)", "").alias("company_id"))


@query("j10_block_pairs", "SELECT a.o_custkey AS block, a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey")
def j10(spark, d):
    return L.block_pairs(table(spark, d, "orders"), "o_custkey", "o_orderkey")


@query("j11_exclude_reviewed", "SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey WHERE (a.o_orderkey + b.o_orderkey) % 3 <> 0")
def j11(spark, d):
    pairs = L.block_pairs(table(spark, d, "orders"), "o_custkey", "o_orderkey").select("a", "b")
    status = F.when((F.col("a") + F.col("b")) % 3 == 0, "rejected").otherwise("pending")
    return L.exclude_reviewed(pairs, pairs.select(F.col("b").alias("a"), F.col("a").alias("b")).withColumn("status", status))


@query("j12_score_text_pairs", f"WITH n AS (SELECT p_partkey, p_name AS t, {TRI.format('p_name')} AS g FROM part) SELECT x.p_partkey AS a, y.p_partkey AS b, round(CASE WHEN x.t = y.t THEN 1.0 ELSE {SIM('x.g', 'y.g')} END, 9) AS text_similarity FROM n x JOIN n y ON y.p_partkey = x.p_partkey + 1")
def j12(spark, d):
    p = table(spark, d, "part")
    pairs = p.select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b"))
    out = L.score_text_pairs(pairs, p, "p_partkey", "p_name")
    return out.select("a", "b", F.round("text_similarity", 9).alias("text_similarity"))


@query("j13_contained_in", "SELECT item_id, doc_id FROM (SELECT item_id, text AS s FROM benchmark WHERE length(text) >= 120), documents WHERE length(text) >= 120 AND contains(text, s)")
def j13(spark, d):
    return L.contained_in(table(spark, d, "benchmark"), "item_id", table(spark, d, "documents"), "doc_id")


@query("j19_partition_discovery", "WITH f AS (SELECT DISTINCT s_nationkey AS k FROM supplier), g AS (SELECT n_nationkey AS k, CASE WHEN n_regionkey = 0 THEN 'approved' ELSE 'excluded' END AS gate FROM nation WHERE n_regionkey <= 1) SELECT k, CASE WHEN f.k IS NULL THEN 'missing' WHEN gate IS NULL THEN 'unapproved' ELSE gate END AS state FROM f FULL JOIN g USING (k) WHERE f.k IS NOT NULL OR gate = 'approved'")
def j19(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_regionkey")
    return L.partition_discovery(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), n.where("n_regionkey = 0"), n.where("n_regionkey = 1"), ["k"])


@query("j21_merge_pairs", "SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey WHERE a.o_orderstatus <> 'F' AND b.o_orderstatus <> 'F'")
def j21(spark, d):
    o = table(spark, d, "orders")
    return L.merge_pairs(L.block_pairs(o, "o_custkey", "o_orderkey").select("a", "b"), o.where("o_orderstatus <> 'F'"), "o_orderkey")


@query("w01_keeper", "SELECT p_name, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size, p_partkey) AS r FROM part) WHERE r = 1")
def w01(spark, d):
    return L.keeper(table(spark, d, "part"), ["p_name"], [F.col("p_size"), F.col("p_partkey")]).select("p_name", "p_partkey")


@query("w07_unique_endpoints", "WITH p AS (SELECT o_custkey AS a, o_orderkey + 1000000000 AS b FROM orders), e AS (SELECT id FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) GROUP BY id HAVING count(*) = 1) SELECT a, b FROM p WHERE a IN (SELECT id FROM e) AND b IN (SELECT id FROM e)")
def w07(spark, d):
    return L.unique_endpoints(table(spark, d, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") + 1_000_000_000).alias("b")))


@query("w08_first_in_batch", "SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) > 1 AS is_duplicate FROM lineitem")
def w08(spark, d):
    return L.first_in_batch(table(spark, d, "lineitem"), ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_partkey", "l_linenumber", "is_duplicate")


@query("g01_source_sets", "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS source_names FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag IN ('A', 'R'))")
def g01(spark, d):
    return L.source_sets(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", ["A", "R"]).withColumn("source_names", F.array_join("source_names", ","))


@query("u01_union_endpoints", "SELECT id, count(*) AS n FROM (SELECT l_partkey AS id FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem) GROUP BY id")
def u01(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").alias("id")).unionByName(li.select(F.col("l_suppkey").alias("id"))).groupBy("id").agg(F.count("*").alias("n"))


@query("u02_distinct_text_pairs", "SELECT DISTINCT p_name, p_brand FROM part")
def u02(spark, d):
    return table(spark, d, "part").select("p_name", "p_brand").distinct()


@query("u03_historical_overlap", "SELECT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' INTERSECT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def u03(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.where("day < '1996-01-01'").select(F.col("o_custkey").alias("k")).intersect(o.where("day >= '2000-01-01'").select("o_custkey"))


@query("u04_scope_difference", "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000")
def u04(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("k")).subtract(table(spark, d, "supplier").where("s_acctbal > 7000").select("s_nationkey"))


@query("u05_preferred_union", "WITH c AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT k, v, 'cached' AS origin FROM c UNION ALL SELECT c_custkey, c_acctbal, 'seed' FROM customer WHERE c_custkey NOT IN (SELECT k FROM c)")
def u05(spark, d):
    cached = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v")).withColumn("origin", F.lit("cached"))
    seed = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.lit("seed").alias("origin"))
    return L.preferred_union(cached, seed, ["k"])


def page_jobs(spark, d):
    """Pages as jobs: the host is the company, the title element the title, the language the place, the text without tags the description."""
    p = table(spark, d, "pages")
    title, lang = F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.regexp_extract("html", '<html[^>]*lang="([^"]*)"', 1)
    text = F.regexp_replace("html", "<[^>]*>", " ")
    return p.select(F.col("page_id").alias("id"), F.lower(F.regexp_extract("url", "^https?://([^/?#]+)", 1)).alias("block"), T.normalize_text(title).alias("title"), lang.alias("location"), F.lit(False).alias("remote"), T.normalize_text(text).alias("description"))


PAGE_JOBS = f"""j AS (SELECT page_id AS id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS block, {NORM.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title, regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang, FALSE AS remote, {NORM.format("regexp_replace(html, '<[^>]*>', ' ', 'g')")} AS description FROM pages)"""


def order_jobs(spark, d):
    """Orders as jobs: the customer is the company, the first line's part the title, the first line's supplier's nation the place (unknown in one
    region), all lines the description; some are remote. Urgent orders come again with two more words in the title, high ones as they are, and medium ones in
    other letters with a longer description, so candidates of every kind grow with the orders."""
    part, nation = table(spark, d, "part"), table(spark, d, "nation")
    place = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("n_regionkey") > 0, F.lower("n_name")).otherwise("").alias("place"))
    words = F.lower(F.concat_ws(" ", "p_name", "p_type", F.replace("p_brand", F.lit("#"), F.lit(" "))))
    # The words come last and once, so they go through one shuffle only.
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").join(place, "l_suppkey").join(part.select(F.col("p_partkey").alias("l_partkey"), words.alias("words")), "l_partkey")
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "words", "place")
    said = F.transform("lines", lambda x: F.concat_ws(" ", x["words"], x["l_quantity"].cast("int").cast("string"), F.lit("pieces")))
    posts = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    orders = table(spark, d, "orders").join(posts, "o_orderkey")
    first = F.col("lines")[0]
    job = orders.select(F.col("o_orderkey").alias("key"), F.col("o_custkey").cast("string").alias("block"), first["words"].alias("title"), first["place"].alias("location"), (F.col("o_orderstatus") == "P").alias("remote"), F.array_join(said, " ").alias("description"), F.substring("o_orderpriority", 1, 1).alias("kind"))
    # The copy is a second element of each row, so lines are joined and gathered once.
    job = job.withColumn("again", F.explode(F.when(F.col("kind").isin("1", "2", "3"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    of = lambda k: (F.col("again") == 1) & (F.col("kind") == k)
    title = F.when(of("1"), F.concat("title", F.lit(" m/w/d"))).when(of("3"), F.concat(F.lit("- "), F.upper("title"))).otherwise(F.col("title"))
    text = F.when(of("3"), F.concat(F.lit("We look for: "), "description", F.lit(". Apply now!"))).otherwise(F.col("description"))
    return job.select((2 * F.col("key") + F.col("again")).alias("id"), "block", T.normalize_text(title).alias("title"), "location", "remote", T.normalize_text(text).alias("description"))


ORDER_JOBS = f"""lines AS (SELECT *, lower(p_name || ' ' || p_type || ' ' || replace(p_brand, '#', ' ')) AS words, CASE WHEN n_regionkey > 0 THEN lower(n_name) ELSE '' END AS place, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
posts AS (SELECT l_orderkey, string_agg(words || ' ' || CAST(l_quantity AS INTEGER) || ' pieces', ' ' ORDER BY r) AS description, min(words) FILTER (r = 1) AS title, min(place) FILTER (r = 1) AS place FROM lines GROUP BY 1),
o AS (SELECT o_orderkey AS key, CAST(o_custkey AS VARCHAR) AS block, title, place, o_orderstatus = 'P' AS remote, description, substr(o_orderpriority, 1, 1) AS kind FROM orders JOIN posts ON o_orderkey = l_orderkey),
e AS (SELECT 2 * key AS id, block, title, place, remote, description FROM o UNION ALL SELECT 2 * key + 1, block, CASE kind WHEN '1' THEN title || ' m/w/d' WHEN '3' THEN '- ' || upper(title) ELSE title END, place, remote, CASE kind WHEN '3' THEN 'We look for: ' || description || '. Apply now!' ELSE description END FROM o WHERE kind IN ('1', '2', '3')),
j AS (SELECT id, block, {NORM.format('title')} AS title, place AS lang, remote, {NORM.format('description')} AS description FROM e)"""


def candidates(jobs: str) -> str:
    """R01 without runs of words, over the jobs `j`."""
    return f"""WITH {jobs},
c AS (SELECT *, min(id) OVER (PARTITION BY block, title, lang, remote, description) AS head FROM j WHERE block <> ''),
g AS (SELECT *, {TRI.format('title')} AS tg FROM c WHERE id = head),
p AS (SELECT x.id AS a, y.id AS b, x.remote OR y.remote AS remote, {SIM('x.tg', 'y.tg')} AS t, CASE WHEN x.lang = '' OR y.lang = '' THEN 0.5 WHEN x.lang = y.lang THEN 1.0 WHEN contains(x.lang, y.lang) OR contains(y.lang, x.lang) THEN 0.95 ELSE {SIM(TRI.format('x.lang'), TRI.format('y.lang'))} END AS l FROM g x JOIN g y ON x.block = y.block AND x.id < y.id
UNION ALL SELECT head, id, remote, CASE WHEN title = '' THEN 0.0 ELSE 1.0 END, CASE WHEN lang = '' THEN 0.5 ELSE 1.0 END FROM c WHERE id <> head),
k AS (SELECT * FROM p WHERE t >= 0.45 AND (l >= 0.20 OR remote)),
m AS (SELECT id, description, {TRI.format('description')} AS dg FROM j WHERE id IN (SELECT a FROM k UNION SELECT b FROM k)),
s AS (SELECT k.*, x.description AS da, y.description AS db, CASE WHEN x.description = '' OR y.description = '' THEN 0.0 WHEN x.description = y.description THEN 1.0 ELSE {SIM('x.dg', 'y.dg')} END AS s FROM k JOIN m x ON a = x.id JOIN m y ON b = y.id)
SELECT a, b, t AS title_similarity, l AS location_similarity, s AS description_similarity, t * 0.62 + l * 0.18 + s * 0.20 AS confidence, (length(da) >= 120 AND contains(db, da)) OR (length(db) >= 120 AND contains(da, db)) AS contained FROM s WHERE t * 0.62 + l * 0.18 + s * 0.20 >= 0.50"""


SCORES = ("title_similarity", "location_similarity", "description_similarity", "confidence")
SCORED = f"SELECT a, b, {', '.join(f'round({x}, 9) AS {x}' for x in SCORES)}, contained FROM ({{}})"


@query("r01_duplicate_candidates", SCORED.format(candidates(ORDER_JOBS)))
def r01(spark, d):
    """With the description score that SQL can state; r01_with_word_similarity has the whole one."""
    c = L.duplicate_candidates(order_jobs(spark, d), words=False)
    return c.select("a", "b", *[F.round(x, 9).alias(x) for x in SCORES], "contained")


@query("r01_page_candidates", SCORED.format(candidates(PAGE_JOBS)))
def r01_pages(spark, d):
    """The same over pages, whose texts are long."""
    c = L.duplicate_candidates(page_jobs(spark, d), words=False)
    return c.select("a", "b", *[F.round(x, 9).alias(x) for x in SCORES], "contained")


@query("r01_with_word_similarity", None)
def r01_words(spark, d):
    """The whole of R01: supported sources only, runs of words in the description score, pending rows made anew beside reviewed ones."""
    jobs = page_jobs(spark, d)
    sources = jobs.select(F.col("id").alias("job_id"), F.when(F.col("location") == "fr", "jooble_direct").otherwise("lever_direct").alias("source_name"))
    reviewed = jobs.select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit("rejected").alias("status"))
    found = L.duplicate_candidates(jobs, reviewed, sources, ["lever_direct"])
    return L.rebuilt_candidates(reviewed, found.select("a", "b", "contained", *SCORES)).where("status = 'pending'").select("a", "b", *[F.round(x, 9).alias(x) for x in SCORES], "contained")


@query("r02_safe_auto_merge", f"WITH s AS (SELECT a, b, confidence FROM ({candidates(ORDER_JOBS)}) WHERE title_similarity >= 0.98 AND location_similarity >= 0.9 AND confidence >= 0.95 AND contained), e AS (SELECT id FROM (SELECT a AS id FROM s UNION ALL SELECT b FROM s) GROUP BY id HAVING count(*) = 1) SELECT a, b, round(confidence, 6) AS confidence FROM s WHERE a IN (SELECT id FROM e) AND b IN (SELECT id FROM e)")
def r02(spark, d):
    """R01 is asked for R02's own thresholds, so pairs that R02 would leave out are not scored first."""
    c = L.duplicate_candidates(order_jobs(spark, d), words=False, **L.SAFE).withColumn("status", F.lit("pending"))
    return L.safe_auto_merge(c).select("a", "b", F.round("confidence", 6).alias("confidence"))
