"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.functions import values as V
from tablewright.plans import table

Q: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        Q[name] = (fn, sql)
        return fn

    return keep


NORM = "trim(regexp_replace(replace(lower(strip_accents(coalesce({0}, ''))), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"
FOLD = "lower(strip_accents({0}))"
#: DuckDB: distinct trigrams of a text's words.
TRI = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


def SIM(a: str, b: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"(CASE WHEN {union} = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / {union} END)"


@query("n01_normalize_text", f"SELECT doc_id, {NORM.format('text')} AS normalized FROM documents")
def n01(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normalized"))


@query("n02_normalize_company", "SELECT p_partkey, trim(regexp_replace(trim(regexp_replace(lower(p_name || ' ' || CASE WHEN p_partkey % 3 = 0 THEN 'S.R.O.' WHEN p_partkey % 3 = 1 THEN 'Ltd.' ELSE '' END), '[^a-z0-9]+', ' ', 'g')), '\\s+(s r o|sro|a s|as|spol s r o|se|ltd|limited|llc|inc|gmbh)$', '')) AS company_key FROM part")
def n02(spark, d):
    name = F.concat_ws(" ", "p_name", F.when(F.col("p_partkey") % 3 == 0, "S.R.O.").when(F.col("p_partkey") % 3 == 1, "Ltd.").otherwise(""))
    return table(spark, d, "part").select("p_partkey", T.normalize_company(name).alias("company_key"))


@query("n03_fold", f"SELECT doc_id, md5({FOLD.format('text')}) AS folded FROM documents")
def n03(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("folded"))


@query("n04_fold_spaces", f"SELECT conv_id, turn, trim(regexp_replace({FOLD.format('text')}, '\\s+', ' ', 'g')) AS folded FROM conversations")
def n04(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.fold_spaces(F.col("text")).alias("folded"))


@query("n05_ascii_fold", f"SELECT doc_id, trim(regexp_replace(regexp_replace({FOLD.format('text')}, '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', ' ', 'g')) AS folded FROM documents")
def n05(spark, d):
    return table(spark, d, "documents").select("doc_id", T.ascii_fold(F.col("text"), words_only=True).alias("folded"))


@query("n06_exact_title_key", "SELECT conv_id, turn, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS title_key FROM conversations")
def n06(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.exact_title_key(F.col("text")).alias("title_key"))


@query("n07_whole_phrase", f"SELECT doc_id, contains(' ' || {NORM.format('text')} || ' ', ' of the ') AS has_phrase FROM documents")
def n07(spark, d):
    return table(spark, d, "documents").select("doc_id", T.has_phrase(T.normalize_text(F.col("text")), F.lit("of the")).alias("has_phrase"))


@query(
    "n08_trigram_similarity",
    f"WITH n AS (SELECT p_partkey, p_name, p_brand, {TRI.format('p_name')} AS a, {TRI.format('p_brand || chr(32) || p_name')} AS b FROM part) SELECT p_partkey, round({SIM('a', 'b')}, 9) AS similarity FROM n",
)
def n08(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(T.similarity(F.col("p_name"), F.concat_ws(" ", "p_brand", "p_name")), 9).alias("similarity"))


#: DuckDB: the trigrams of a text's words in order, and N09 over all extents one by one.
ROW = TRI.removeprefix("list_distinct(").removesuffix(")")


def WORDS(short: str, long: str) -> str:
    """N09 of two trigram lists, the second in order."""
    part = f"list_distinct(list_slice({long}, i, j))"
    hit = f"list_filter(range(1, len({long}) + 1), lambda k: list_contains({short}, {long}[k]))"
    share = f"len(list_intersect({short}, {part})) / len(list_distinct(list_concat({short}, {part})))"
    return f"coalesce(list_max(flatten(list_transform({hit}, lambda i: list_transform(list_filter({hit}, lambda j: j >= i), lambda j: {share})))), 0.0)"


@query(
    "n09_word_similarity",
    f"WITH p AS (SELECT DISTINCT p_brand AS short, p_name || ' ' || p_brand || ' ' || p_type AS long FROM part), t AS (SELECT *, {TRI.format('short')} AS s, {ROW.format('long')} AS l FROM p) SELECT short, long, round({WORDS('s', 'l')}, 9) AS word_similarity FROM t",
)
def n09(spark, d):
    from tablewright.functions.word_similarity import word_similarity

    pairs = table(spark, d, "part").select(F.col("p_brand").alias("short"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("long")).distinct()
    return pairs.select("short", "long", F.round(word_similarity("short", "long"), 9).alias("word_similarity"))


@query(
    "n10_location_similarity",
    f"WITH n AS (SELECT s_suppkey, lower(replace(n_name, '_', ' ')) AS a, lower(CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN s_suppkey % 4 = 1 THEN replace(n_name, '_', ' ') WHEN s_suppkey % 4 = 2 THEN replace(n_name, '_', ' ') || ' ' || r_name ELSE r_name END) AS b FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), t AS (SELECT *, {TRI.format('a')} AS ta, {TRI.format('b')} AS tb FROM n) SELECT s_suppkey, round(CASE WHEN a = '' OR b = '' THEN 0.5 WHEN a = b THEN 1.0 WHEN contains(a, b) OR contains(b, a) THEN 0.95 ELSE {SIM('ta', 'tb')} END, 9) AS location_similarity FROM t",
)
def n10(spark, d):
    n = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name, k = F.replace("n_name", F.lit("_"), F.lit(" ")), F.col("s_suppkey") % 4
    other = F.when(k == 0, "").when(k == 1, name).when(k == 2, F.concat_ws(" ", name, "r_name")).otherwise(F.col("r_name"))
    return n.select("s_suppkey", F.round(V.location_similarity(F.lower(name), F.lower(other)), 9).alias("location_similarity"))


ENT = "replace(replace(replace(replace(replace(replace({0}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


@query("n11_strip_tags", f"SELECT page_id, md5(trim(regexp_replace({ENT.format(chr(114) + 'egexp_replace(html, ' + chr(39) + '<[^>]*>' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}, '\\s+', ' ', 'g'))) AS stripped FROM pages")
def n11(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.strip_tags(F.col("html"))).alias("stripped"))


URL = "lower(rtrim(split_part(split_part({0}, '#', 1), '?', 1), '/'))"


@query("n12_normalize_url", f"SELECT page_id, {URL.format('url')} AS url_key FROM pages")
def n12(spark, d):
    return table(spark, d, "pages").select("page_id", T.normalize_url(F.col("url")).alias("url_key"))


@query("n13_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS none FROM events")
def n13(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.get_json_object("props", "$.none").alias("none"))


@query("n14_amount", "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN floor(o_totalprice) * 1000 ELSE floor(o_totalprice) END AS BIGINT) AS amount, CAST(floor(o_totalprice) / 100 * 100 AS BIGINT) AS minor FROM orders")
def n14(spark, d):
    whole, k = F.floor("o_totalprice").cast("string"), F.col("o_orderkey") % 5
    label = F.when(k == 0, F.concat(F.lit("-"), whole)).when(k == 1, F.concat(whole, F.lit("k"))).when(k == 2, F.format_number(F.floor("o_totalprice"), 0)).otherwise(whole)
    return table(spark, d, "orders").select("o_orderkey", V.amount(label).cast("long").alias("amount"), (V.minor_units(F.floor("o_totalprice"), F.lit("EUR")) * 100).cast("long").alias("minor"))


@query("n15_vocabularies", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'hour' WHEN 1 THEN 'month' WHEN 2 THEN 'year' ELSE 'unknown' END AS period, CASE o_orderkey % 4 WHEN 0 THEN 'remote' WHEN 1 THEN 'onsite' WHEN 2 THEN 'hybrid' END AS mode, CASE o_orderkey % 4 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' END AS schedule, CASE o_orderkey % 4 WHEN 1 THEN 'intern' WHEN 2 THEN 'contractor' END AS relationship, CASE o_orderkey % 4 WHEN 0 THEN 'permanent' WHEN 3 THEN 'fixed_term' END AS duration, CASE o_orderkey % 4 WHEN 0 THEN 'senior' WHEN 1 THEN 'entry' END AS level FROM orders")
def n15(spark, d):
    k = F.col("o_orderkey") % 4
    pick = lambda *v: F.when(k == 0, v[0]).when(k == 1, v[1]).when(k == 2, v[2]).otherwise(v[3])
    work = V.employment_values(pick("Full-time permanent", "part time internship", "Freelance", "Fixed-term"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        V.pay_period(pick("Hourly", "1 month", "ANNUAL", "weekly")).alias("period"),
        V.workplace_mode(pick("Fully_Remote", "On-site", " hybrid ", "moon")).alias("mode"),
        work["schedule"].alias("schedule"),
        work["relationship"].alias("relationship"),
        work["duration"].alias("duration"),
        V.native_level(pick("Senior", "Entry level", "guru", "x")).alias("level"),
    )


@query("n16_semantic_hash", """SELECT doc_id, sha256('{"lang":"' || lang || '","n":' || n_chars || '}') AS input_hash FROM documents""")
def n16(spark, d):
    return table(spark, d, "documents").select("doc_id", V.semantic_hash(F.col("lang").alias("lang"), F.col("n_chars").alias("n")).alias("input_hash"))


@query("n17_array_sets", "SELECT o_custkey, len(list_distinct(list(o_orderstatus))) AS n_distinct, list_has_any(list(o_orderstatus), ['P']) AS overlaps, list_has_all(['F','O','P'], list(o_orderstatus)) AS is_subset FROM orders GROUP BY o_custkey")
def n17(spark, d):
    s = F.collect_set("o_orderstatus")
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.size(s).cast("long").alias("n_distinct"), F.arrays_overlap(s, F.array(F.lit("P"))).alias("overlaps"), (F.size(F.array_except(s, F.array(*map(F.lit, "FOP")))) == 0).alias("is_subset")
    )


@query("n18_json_merge", """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"state":"' || event_type || '"}' AS payload FROM events""")
def n18(spark, d):
    merged = F.map_concat(F.from_json("props", "map<string,bigint>"), F.create_map(F.lit("n"), F.lit(1).cast("long")))
    return table(spark, d, "events").select("event_id", F.to_json(F.struct(merged["k"].alias("k"), F.col("event_type").alias("state"))).alias("payload"))


@query("n19_sql_helpers", "SELECT page_id, greatest(page_id, length(url)) AS hi, least(page_id, length(url)) AS lo, split_part(url, '/', 3) AS host, CAST(strpos(url, 'example') AS BIGINT) AS at, nullif(split_part(url, '?', 2), '') AS query FROM pages")
def n19(spark, d):
    size = F.length("url").cast("long")
    return table(spark, d, "pages").select(
        "page_id", F.greatest("page_id", size).alias("hi"), F.least("page_id", size).alias("lo"), F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.position(F.lit("example"), "url").cast("long").alias("at"), F.nullif(F.split_part("url", F.lit("?"), F.lit(2)), F.lit("")).alias("query")
    )


@query("n20_age_days", "SELECT event_id, round(epoch_us(TIMESTAMP '2024-01-31' - 0 * INTERVAL 1 DAY) / 86400e6 - epoch_us(ts) / 86400e6, 6) AS age, ts < TIMESTAMP '2024-01-31' - INTERVAL 72 HOUR AS stale FROM events")
def n20(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    age = V.age_days(now.cast("timestamp"), F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", F.round(age, 6).alias("age"), (F.col("ts") < now - F.expr("INTERVAL 72 HOURS")).alias("stale"))


@query("p02_native_id", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN 'acme:' || o_custkey || ':' || o_orderkey END AS native_id FROM orders")
def p02(spark, d):
    scope = F.when(F.col("o_orderkey") % 7 == 0, F.lit("a:b")).otherwise(F.lit("acme"))
    return table(spark, d, "orders").select("o_orderkey", V.native_id([scope, F.col("o_custkey").cast("string")], F.col("o_orderkey").cast("string"), "digits").alias("native_id"))


PATH = r"^/([a-z]{2})/([0-9]+)(?:\.html)?/?$"


@query("p03_url_identity", r"SELECT page_id, CASE WHEN ok THEN host END AS host, CASE WHEN ok THEN regexp_extract(path, '^/([a-z]{2})/([0-9]+)', 1) END AS scope, CASE WHEN ok THEN regexp_extract(path, '^/([a-z]{2})/([0-9]+)', 2) END AS posting FROM (SELECT *, regexp_matches(host, '^([a-z0-9-]+\.)*example\.(com|org)$') AND regexp_matches(path, '^/([a-z]{2})/([0-9]+)(?:\.html)?/?$') AS ok FROM (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#@:]+)', 1)) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages))")
def p03(spark, d):
    found = V.url_identity(F.col("url"), r"^([a-z0-9-]+\.)*example\.(com|org)$", PATH, "scope", "posting", schemes="https?", ports=())
    return table(spark, d, "pages").withColumn("f", found).select("page_id", "f.host", "f.scope", "f.posting")


@query("p04_region_evidence", "SELECT s_suppkey, CASE WHEN c = 'NATION_3' THEN 'country_code' WHEN o = 'NATION_3' THEN 'secondary_country' WHEN c IS NULL AND regexp_matches(label, 'nation 1\\b') THEN 'label' END AS evidence FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN n_name END AS c, CASE WHEN s_suppkey % 5 = 0 THEN 'NATION_3' END AS o, lower(replace(n_name, '_', ' ')) AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey)")
def p04(spark, d):
    n = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    country = F.when(F.col("s_suppkey") % 2 == 0, F.col("n_name"))
    others = F.array_compact(F.array(F.when(F.col("s_suppkey") % 5 == 0, F.lit("NATION_3"))))
    return n.select("s_suppkey", V.region_evidence(country, others, F.replace("n_name", F.lit("_"), F.lit(" ")), "NATION_3", ["nation 1"]).alias("evidence"))


@query("p05_foreign_pruning", "SELECT r_name, len(list(n_name) FILTER (WHERE n_name <> 'NATION_3')) = count(*) AS foreign_only, CASE WHEN bool_or(n_name = 'NATION_3') THEN NULL ELSE 'foreign_location' END AS reason FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def p05(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.collect_list("n_name").alias("places"))
    return n.select("r_name", V.clearly_foreign(F.col("places"), "NATION_3").alias("foreign_only"), V.ineligible_reason(F.col("places"), "NATION_3").alias("reason"))


@query("p06_remote_type", "SELECT event_id, CASE event_type WHEN 'signup' THEN 'hybrid' WHEN 'view' THEN 'remote' WHEN 'click' THEN 'onsite' ELSE 'unknown' END AS remote_type, CASE WHEN event_type = 'view' THEN 'remote' ELSE 'unknown' END AS smart, CASE event_type WHEN 'view' THEN 'remote' WHEN 'click' THEN 'onsite' WHEN 'error' THEN 'hybrid' ELSE 'unknown' END AS workday, CASE event_type WHEN 'purchase' THEN 'remote' WHEN 'error' THEN 'hybrid' ELSE 'unknown' END AS apify FROM events")
def p06(spark, d):
    e, kind = table(spark, d, "events"), F.col("event_type")
    label = V.mapped(kind, {"signup": "Hybrid / remote", "view": "Home office", "click": "On-Site only", "error": "n/a"})
    flag = V.mapped(kind, {"view": "true", "click": "false", "signup": "remote"})
    workday = V.mapped(kind, {"view": "Fully Remote", "click": "In Person", "error": "Partially remote", "signup": "On site only"})
    apify = V.mapped(kind, {"purchase": "TELECOMMUTE", "error": "Hybrid Remote", "view": "in person"})
    return e.select("event_id", V.remote_type(label).alias("remote_type"), V.remote_type(flag, "smartrecruiters_direct").alias("smart"), V.remote_type(workday, "workday_direct").alias("workday"), V.remote_type(apify, "fantastic_jobs_apify").alias("apify"))


@query("p07_location_text", "SELECT n_nationkey, n_name || ', ' || r_name || CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE ' | ' || r_name END AS location_text FROM nation JOIN region ON n_regionkey = r_regionkey")
def p07(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    second = F.when(F.col("n_nationkey") % 2 == 0, F.array("n_name", "r_name")).otherwise(F.array("r_name", F.lit(" "), "r_name"))
    return n.select("n_nationkey", V.location_text(F.array("n_name", F.lit(None).cast("string"), "r_name"), second).alias("location_text"))


@query("p08_description", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS description FROM conversations WHERE trim(text) <> '' GROUP BY conv_id")
def p08(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return c.select("conv_id", V.joined_description(F.transform("t", lambda x: x["text"])).alias("description")).where("description <> ''")


@query("p09_salary_text", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'from ' || o_custkey || ' ' ELSE '' END || '{"min":' || o_custkey || ',"max":' || o_orderkey || ',"currency":"EUR"}' AS salary_text FROM orders""")
def p09(spark, d):
    label = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("from "), F.col("o_custkey"), F.lit(" "))).otherwise(F.lit(" "))
    return table(spark, d, "orders").select("o_orderkey", V.salary_text(label, F.col("o_custkey"), F.col("o_orderkey"), F.lit("EUR")).alias("salary_text"))


@query("p10_timestamps", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders")
def p10(spark, d):
    t, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 5
    label = F.when(k == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format(t, "yyyy-MM-dd")).when(k == 2, F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss '+0000'")).when(k == 3, F.date_format(t, "EEE MMM dd HH:mm:ss 'UTC' yyyy")).otherwise(F.lit("soon"))
    return table(spark, d, "orders").select("o_orderkey", F.date_format(V.parse_timestamp(label), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("p14_field_is_empty", "SELECT doc_id, length(trim(text)) = 0 AS text_empty, source = 'src0' AS mode_empty, lang IS NULL AS lang_empty FROM documents")
def p14(spark, d):
    mode = F.when(F.col("source") == "src0", "unknown").otherwise("remote")
    return table(spark, d, "documents").select("doc_id", V.field_is_empty("text", F.col("text")).alias("text_empty"), V.field_is_empty("remote_type", mode).alias("mode_empty"), V.field_is_empty("skills", F.array_compact(F.array("lang")), "array").alias("lang_empty"))


@query("p15_redact", r"SELECT page_id, regexp_replace('GET ' || '[url]' || ' token=[redacted] sid=[redacted]', 'x^', '') AS message FROM pages")
def p15(spark, d):
    return table(spark, d, "pages").select("page_id", T.redact(F.concat(F.lit("GET "), F.col("url"), F.lit(" token: abc"), F.col("page_id"), F.lit(" sid=A1.b"))).alias("message"))


@query("p16_page_platform", r"SELECT page_id, CASE WHEN regexp_matches(url, '^https?://([^/]*\.)?example\.(com|org)(/|$)') AND contains(html, '<article>') THEN 'article' ELSE 'unknown' END AS platform FROM pages")
def p16(spark, d):
    return table(spark, d, "pages").select("page_id", V.page_platform(F.col("url"), F.col("html")).alias("platform"))
