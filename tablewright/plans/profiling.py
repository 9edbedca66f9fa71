"""Queries of extraction, profile and evaluation operators. The driver's text is invented prose, so dictionaries and patterns are taken from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import evaluation as E
from tablewright.operators import extraction as X
from tablewright.operators import html_text as HT
from tablewright.operators import places as PL
from tablewright.operators import profiles as P
from tablewright.plans import table
from tablewright.sources import landing as S
from tablewright.sources.dimensions import CITY_ALIASES, COUNTRY_ALIASES, REGION_ALIASES
from tablewright.storage import spread

Q: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        Q[name] = (fn, sql)
        return fn

    return keep


@query("x01_clean_html", None)
def x01(spark, d):
    return HT.clean_html(table(spark, d, "pages"), "page_id", "html")


QUALITY = r"CASE WHEN text = '' THEN 'empty' WHEN regexp_matches(text, '(\.\.\.|…)\s*$') THEN 'snippet' WHEN source = 'src3' THEN 'snippet' WHEN length(text) < 500 OR len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) < 60 THEN 'short' ELSE 'complete' END"


@query("x02_description_quality", f"SELECT doc_id, {QUALITY} AS quality FROM documents")
def x02(spark, d):
    return table(spark, d, "documents").select("doc_id", X.description_quality(F.col("text"), F.col("source"), ("src3",)).alias("quality"))


@query("x03_title_facts", """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'senior' WHEN p_size % 3 = 1 THEN 'junior,staff' ELSE '' END AS levels,
CASE p_partkey % 8 WHEN 0 THEN 'lead' WHEN 1 THEN 'manager' WHEN 3 THEN 'director' WHEN 4 THEN 'manager' WHEN 5 THEN 'director,manager' WHEN 6 THEN 'head,vedouci' ELSE '' END AS leaders,
CASE WHEN p_size % 3 = 1 THEN 'Staff ' ELSE '' END || p_name || CASE p_partkey % 8 WHEN 0 THEN ' Lead' WHEN 1 THEN ' Manager' WHEN 2 THEN ' lead generation' WHEN 3 THEN ' ředitelka' WHEN 4 THEN ' manazer' WHEN 5 THEN ' reditel manažerů' WHEN 6 THEN ' head vedoucí' ELSE '' END AS role FROM part""")
def x03(spark, d):
    tail = F.element_at(F.array(*map(F.lit, (" Lead", " Manager (m/f/d)", " lead generation", " ředitelka (W/M/D)", " manazer", " reditel manažerů", " head vedoucí", ""))), (F.col("p_partkey") % 8 + 1).cast("int"))
    front = F.element_at(F.array(*map(F.lit, ("Senior ", "Jr. Staff ", ""))), (F.col("p_size") % 3 + 1).cast("int"))
    f = X.title_facts(F.concat(front, "p_name", tail))
    return table(spark, d, "part").select("p_partkey", F.array_join(f["levels"], ",").alias("levels"), F.array_join(f["leaders"], ",").alias("leaders"), f["role"].alias("role"))


@query("x04_dictionary_mentions", "SELECT doc_id, value, count(*) AS n, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS exact_spans FROM (SELECT doc_id, w AS value, true AS ok FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS w FROM documents) WHERE w IN ('that', 'nicht')) GROUP BY 1, 2")
def x04(spark, d):
    docs = table(spark, d, "documents")
    m = X.dictionary_mentions(docs, "doc_id", "text", {"that": "that", "nicht": "nicht"}).join(docs.select("doc_id", F.col("text").alias("t")), "doc_id")
    right = F.col("t").substr(F.col("start") + 1, F.col("end") - F.col("start")) == F.col("text")
    return m.groupBy("doc_id", "value").agg(F.count("*").alias("n"), F.sum(right.cast("long")).alias("exact_spans"))


@query("x05_language_requirements", """WITH c AS (SELECT conv_id, turn, role FROM conversations)
SELECT conv_id, turn, 'en' AS language, CASE WHEN role = 'user' THEN 'required' ELSE 'preferred' END AS requirement, 'B2' AS cefr, CASE WHEN turn % 2 = 0 THEN 'at_least' ELSE 'unknown' END AS comparator, 0 AS "start" FROM c
UNION ALL SELECT conv_id, turn, 'de', 'unknown', 'C1', 'exact', 25 FROM c
UNION ALL SELECT conv_id, turn, 'fr', 'required', NULL, NULL, 50 FROM c UNION ALL SELECT conv_id, turn, 'es', 'required', NULL, NULL, 50 FROM c""")
def x05(spark, d):
    """Three clauses before each turn: a qualifier behind the language, a level before it, and one shared by two languages."""
    line = F.concat(F.lit("English B2"), F.when(F.col("turn") % 2 == 0, "+").otherwise(" "), F.lit(" "), F.when(F.col("role") == "user", "required").otherwise("advantage"))
    text = F.concat(F.rpad(line, 24, " "), F.lit(";"), F.rpad(F.lit("level exactly C1 German"), 24, " "), F.lit(","), F.lit("French and Spanish required\n"), F.lit("Czech Republic native; "), "role")
    c = table(spark, d, "conversations").select(F.struct("conv_id", "turn").alias("id"), text.alias("text"))
    return X.language_requirements(c, "id", "text").select("id.conv_id", "id.turn", "language", "requirement", "cefr", "comparator", "start")


@query("x06_experience_ranges", """WITH k AS (SELECT doc_id, CAST(n_chars % 12 + 1 AS INT) AS a, doc_id % 6 AS form FROM documents)
SELECT doc_id, CASE WHEN form = 3 THEN 7 ELSE a END AS min_years, CASE WHEN form IN (0, 2) THEN a + 2 END AS max_years FROM k WHERE form NOT IN (4, 5)""")
def x06(spark, d):
    a, form = F.col("n_chars") % 12 + 1, F.col("doc_id") % 6
    n, m = a.cast("string"), (a + 2).cast("string")
    line = (
        F.when(form == 0, F.concat(F.lit("Ask: "), n, F.lit("-"), m, F.lit(" years of experience")))
        .when(form == 1, F.concat(F.lit("Minimalne "), n, F.lit(" roky, zkusenost")))
        .when(form == 2, F.concat(n, F.lit(" az "), m, F.lit(" let praxe")))
        .when(form == 3, F.lit("at least Seven years"))
        .when(form == 4, F.concat(n, F.lit("+ years of experience since our company was founded")))
        .otherwise(F.concat(m, F.lit(" to "), F.lit("1 years of experience")))
    )
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.regexp_replace("text", "[0-9]+", ""), F.lit("\n"), line).alias("text"))
    return X.experience_ranges(docs, "doc_id", "text").select("doc_id", "min_years", "max_years")


@query("x07_sections", "SELECT conv_id, turn, 'requirements' AS kind, 0 AS start, length(text) + 17 AS \"end\", trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS content FROM conversations WHERE trim(text, ' ' || chr(10) || chr(9) || chr(13)) <> '' UNION ALL SELECT conv_id, turn, 'benefits', length(text) + 17, length(text) + 17 + 14 + length(role), role FROM conversations")
def x07(spark, d):
    c = table(spark, d, "conversations").select(F.struct("conv_id", "turn").alias("id"), F.concat(F.lit("## Requirements\n"), "text", F.lit("\nWhat we offer\n"), "role").alias("text"))
    out = X.section_spans(c, "id", "text", {"requirements": "requirements", "what we offer": "benefits"})
    return out.select("id.conv_id", "id.turn", "kind", "start", "end", "content")


@query("w09_section_spans", "SELECT doc_id, k, \"start\", coalesce(lead(\"start\") OVER (PARTITION BY doc_id ORDER BY k), n) AS stop FROM (SELECT doc_id, k, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS \"start\", n FROM (SELECT doc_id, n, unnest(p) AS line, unnest(range(len(p))) AS k FROM (SELECT doc_id, length(text) AS n, string_split(text, chr(10)) AS p FROM documents)))")
def w09(spark, d):
    from pyspark.sql import Window

    docs = table(spark, d, "documents")
    ln = X.lines_of(docs, "doc_id", "text").join(docs.select("doc_id", F.length("text").alias("n")), "doc_id")
    return ln.select("doc_id", "k", "start", F.coalesce(F.lead("start").over(Window.partitionBy("doc_id").orderBy("k")), "n").alias("stop"))


@query("w10_neighbour_context", None)
def w10(spark, d):
    docs = table(spark, d, "documents")
    m = X.dictionary_mentions(docs, "doc_id", "text", {"that": "that"})
    return X.neighbour_context(m, ["doc_id"], docs, "doc_id", "text").select("doc_id", "start", F.length("before").alias("n_before"), F.length("after").alias("n_after"))


@query("x08_pay_offers", """SELECT p_partkey, CAST(p_size * 1000 AS DECIMAL(18,4)) AS low, CAST((p_size + 5) * 1000 AS DECIMAL(18,4)) AS high, 'CZK' AS currency, 'month' AS period, 'gross' AS basis, 'base' AS component, CASE WHEN p_size % 2 = 0 THEN 'Brno' END AS places, 7 AS "start" FROM part
UNION ALL SELECT p_partkey, CAST(p_size * 1000 AS DECIMAL(18,4)), NULL, 'EUR', 'year', 'unknown', 'unknown', NULL, CAST(73 + length(CAST(p_size AS VARCHAR)) + length(CAST(p_size + 5 AS VARCHAR)) AS INT) FROM part""")
def x08(spark, d):
    size, more = F.col("p_size").cast("string"), (F.col("p_size") + 5).cast("string")
    place = F.when(F.col("p_size") % 2 == 0, " in Brno").otherwise(" at home")
    line = F.concat(F.lit("Salary "), size, F.lit(" 000 - "), more, F.lit(",000 Kč / month gross"), place, F.lit("\nbonus   500 EUR per year   .\n€ "), size, F.lit("k annually\n"), more, F.lit("-"), F.lit("1 EUR per day"))
    return X.pay_offers(spread(table(spark, d, "part")).select("p_partkey", line.alias("text")), "p_partkey", "text", CITY_ALIASES).select("p_partkey", "low", "high", "currency", "period", "basis", "component", "places", "start")


@query("x09_monetary_benefits", """SELECT p_partkey, 'meal allowance ' || p_size || ' CZK per day' AS text, length(p_name) + 1 AS "start" FROM part""")
def x09(spark, d):
    line = F.concat("p_name", F.lit("\nmeal allowance "), "p_size", F.lit(" CZK per day\nSalary 900 EUR per month\npension plan"))
    return X.monetary_benefits(spread(table(spark, d, "part")).select("p_partkey", line.alias("text")), "p_partkey", "text").select("p_partkey", "text", "start")


@query("x10_arrangement_clauses", "SELECT doc_id, value, count(*) AS n FROM (SELECT doc_id, CASE WHEN regexp_matches(line, '\\bthat\\b') THEN 'a' WHEN regexp_matches(line, '\\bwith\\b') THEN 'b' END AS value FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE value IS NOT NULL GROUP BY 1, 2")
def x10(spark, d):
    return X.arrangement_clauses(table(spark, d, "documents"), "doc_id", "text", [(r"\bthat\b", "a"), (r"\bwith\b", "b")]).groupBy("doc_id", "value").agg(F.count("*").alias("n"))


@query("x11_opportunity_type", "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'talent_pool' WHEN 1 THEN 'hackathon' WHEN 2 THEN NULL WHEN 3 THEN 'conflict' WHEN 4 THEN 'vacancy' WHEN 5 THEN NULL ELSE 'talent_pool' END AS kind FROM documents")
def x11(spark, d):
    k = F.col("doc_id") % 7
    title = F.when(k == 0, "Talent pool manager").when(k == 1, "Hackathon 2026").when(k == 2, "Career fair coordinator").when(k == 3, "Talent pool graduate programme").otherwise("Baker")
    extra = F.when(k == 4, "\nWe are hiring a baker for nights").when(k == 5, "\nWe are looking for a partner community").when(k == 6, "\nThere is no suitable vacancy today. Send us your CV anyway").otherwise("")
    return spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", X.opportunity_type(title, F.concat("text", extra)).alias("kind"))


PLACES = """SELECT s_suppkey, CASE s_suppkey % 9 WHEN 0 THEN 'Plzeň' WHEN 1 THEN 'Prague' WHEN 5 THEN 'Brno' WHEN 6 THEN 'Brno' END AS city, CASE s_suppkey % 9 WHEN 8 THEN 'Jihomoravský kraj' END AS region,
CASE WHEN s_suppkey % 9 IN (0, 1, 5, 6, 8) THEN 'CZ' WHEN s_suppkey % 9 = 2 THEN 'DE' WHEN s_suppkey % 9 = 4 THEN 'AT' END AS country, CASE s_suppkey % 9 WHEN 3 THEN 'workplace_or_broad_scope' WHEN 7 THEN 'url_or_domain' END AS reason FROM supplier"""


def place_labels():
    texts = ("Pilsen", "Praha, Česká republika", "Germany - Hof", "Remote", "Brno / Austria", "Hybrid in Brno 12", "CZ-Brno", "www.jobs.example.com", "South Moravian Region")
    return F.element_at(F.array(*map(F.lit, texts)), (F.col("s_suppkey") % 9 + 1).cast("int"))


@query("x12_place_labels", PLACES)
def x12(spark, d):
    return table(spark, d, "supplier").withColumn("p", PL.parse_place_label(place_labels(), COUNTRY_ALIASES, CITY_ALIASES, REGION_ALIASES)).select("s_suppkey", "p.city", "p.region", "p.country", "p.reason")


#: Labels in the layouts that feeds use, with what they mean: city, region, country, reason.
LAYOUTS = (
    ("Office (Brno)", None, None, None, "unknown_label"), ("Germany Prague", None, None, "DE", None), ("Zlínský kraj", None, "Zlínský kraj", "CZ", None), ("Remote (Brno)", "Brno", None, "CZ", None),
    ("Prague (Germany)", None, None, "DE", None), ("Plzeň (centrum)", "Plzeň", None, "CZ", None), ("Brno, Zlin Region", "Brno", "Zlínský kraj", "CZ", None), ("Czech Republic  Ústí nad Labem", "Ústí nad Labem", None, "CZ", None),
    ("Brandýs nad Labem-Stará Boleslav", None, None, None, "unknown_label"), ("hybrid-brno-cz", "Brno", None, "CZ", None), ("Praha 4 > Remote", "Prague", None, "CZ", None), ("Liberec; Olomouc", None, None, None, "unknown_label"),
)


def listed(*columns: list) -> str:
    """The columns of a small list as DuckDB values, by position from 0."""
    text = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return ", ".join(f"({n}, {', '.join(map(text, row))})" for n, row in enumerate(zip(*columns, strict=True)))


@query("x12_place_layouts", f"SELECT c_custkey, city, region, country, reason FROM customer JOIN (VALUES {listed(*[[r[i] for r in LAYOUTS] for i in range(1, 5)])}) v(n, city, region, country, reason) ON c_custkey % {len(LAYOUTS)} = n")
def x12_layouts(spark, d):
    label = F.element_at(F.array(*[F.lit(r[0]) for r in LAYOUTS]), (F.col("c_custkey") % len(LAYOUTS) + 1).cast("int"))
    return table(spark, d, "customer").withColumn("p", PL.parse_place_label(label, COUNTRY_ALIASES, CITY_ALIASES, REGION_ALIASES)).select("c_custkey", "p.city", "p.region", "p.country", "p.reason")


#: City fields, the row's country, and the city that they name.
CITY_FIELDS = (
    ("Brno, Czechia", "CZ", "Brno"), ("Lhota (office)", "CZ", "Lhota"), ("Lhota (office)", None, None), ("Lhota, Lhota, Czech Republic", "CZ", "Lhota"), ("Lhota, Brno, Czechia", "CZ", None), ("Berlin, Deutschland", "DE", "Berlin"),
    ("Lhota 3, Czechia", "CZ", "Lhota"), ("Lhota 3", "DE", None), ("Prague", "DE", None), ("Zlínský kraj", "CZ", None), ("Slovakia", "SK", None), ("Nové Město na Moravě", "CZ", "Nové Město na Moravě"), ("Brno (Office/Factory), Czechia", "CZ", "Brno"),
)


@query("x13_city_fields", f"SELECT c_custkey, city FROM customer JOIN (VALUES {listed([r[2] for r in CITY_FIELDS])}) v(n, city) ON c_custkey % {len(CITY_FIELDS)} = n")
def x13_fields(spark, d):
    at = (F.col("c_custkey") % len(CITY_FIELDS) + 1).cast("int")
    value, country = (F.element_at(F.array(*[F.lit(r[i]) for r in CITY_FIELDS]), at) for i in (0, 1))
    return table(spark, d, "customer").select("c_custkey", PL.typed_city(value, CITY_ALIASES, COUNTRY_ALIASES, REGION_ALIASES, country).alias("city"))


@query("x13_subdivisions", "SELECT c_custkey, CASE c_custkey % 4 WHEN 3 THEN NULL ELSE n_name END AS region FROM customer JOIN nation ON c_nationkey = n_nationkey")
def x13_subdivisions(spark, d):
    """Nations as subdivisions of their regions, in a file like the public list; customers name theirs by code, by name, by the code's end, or with the code of another region's."""
    from tablewright.sources.dimensions import load_dimension
    from tablewright.storage import scratch

    n = table(spark, d, "nation").withColumns({"country": F.concat(F.lit("R"), "n_regionkey"), "other": F.concat(F.lit("R"), F.col("n_regionkey") + 7)})
    code = F.concat_ws("-", "country", F.concat(F.lit("N"), "n_nationkey"))
    path = scratch(spark, "subdivisions")
    n.agg(F.collect_list(F.struct(code.alias("code"), F.col("n_name").alias("name"), F.lit("Nation").alias("type"))).alias("3166-2")).write.json(path)
    k = F.col("c_custkey") % 4
    value = F.when(k == 0, F.lower(code)).when(k == 1, F.concat(F.lit(" "), F.upper("n_name"))).when(k == 2, F.concat(F.lit("n"), "n_nationkey")).otherwise(F.concat_ws("-", "other", F.lit("N1")))
    rows = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country", value.alias("value"))
    return PL.typed_subdivisions(rows, "value", "country", load_dimension(spark, "subdivisions", path)).select("c_custkey", "region")


@query("x13_typed_places", "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Brno' WHEN 1 THEN 'Customer Town' WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 'Ostrava' ELSE NULL END AS city, CASE WHEN c_custkey % 2 = 0 THEN 'Jihomoravský kraj' END AS region FROM customer")
def x13(spark, d):
    k = F.col("c_custkey")
    city = F.element_at(F.array(*map(F.lit, ("Brno 3", "Customer Town", "Germany", "Olomoucký kraj", "OSTRAVA", "office campus 12"))), (k % 6 + 1).cast("int"))
    region, country = F.when(k % 2 == 0, "South Moravian Region").otherwise("somewhere"), F.when(k % 3 == 0, "CZ")
    return table(spark, d, "customer").select("c_custkey", PL.typed_city(city, CITY_ALIASES, COUNTRY_ALIASES, REGION_ALIASES, country).alias("city"), PL.typed_region(region, REGION_ALIASES, country).alias("region"))


@query("x14_project_locations", f"SELECT s_suppkey, 0 AS position, city, region, country, CASE WHEN country IS NOT NULL THEN CASE WHEN s_suppkey % 9 IN (1, 2, 4, 6) THEN 'explicit' ELSE 'inferred' END END AS country_evidence, reason FROM ({PLACES}) UNION ALL SELECT s_suppkey, 1, 'Prague', NULL, 'CZ', 'inferred', NULL FROM supplier")
def x14(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(place_labels(), F.lit(" | Praha")).alias("label"))
    return PL.project_locations(s, "s_suppkey", "label", COUNTRY_ALIASES, CITY_ALIASES, REGION_ALIASES).select("s_suppkey", "position", "city", "region", "country", "country_evidence", "reason")


@query("x15_native_facts", "SELECT event_id, 'k' AS field, json_extract_string(props, '$.k') AS value, '$.k' AS path, 'native' AS method FROM events")
def x15(spark, d):
    return X.native_facts(table(spark, d, "events"), "event_id", "props", {"k": "$.k", "none": "$.none"})


@query("x16_native_offers", "SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS low, CAST(o_orderkey AS BIGINT) AS high, 'month' AS period FROM orders WHERE o_custkey > 0 AND o_orderkey >= o_custkey AND o_orderkey % 3 <> 0")
def x16(spark, d):
    offer = X.native_offers(F.col("o_custkey") * 100, F.col("o_orderkey") * 100, F.when(F.col("o_orderkey") % 3 != 0, "EUR"), F.lit("Monthly"), minor=True)
    return table(spark, d, "orders").withColumn("f", offer).where("f IS NOT NULL").select("o_orderkey", F.col("f.low").cast("long").alias("low"), F.col("f.high").cast("long").alias("high"), "f.period")


@query(
    "x16_scoped_offers",
    """WITH r AS (SELECT o_orderkey AS k, o_custkey AS c, unnest([0, 1, 2, 3]) AS position FROM orders), v AS (SELECT *, CASE WHEN c > 0 THEN c END AS lo, CASE position WHEN 1 THEN NULL ELSE CASE WHEN k > 0 THEN k END END AS hi, CASE k % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'CHF' WHEN 2 THEN 'JPY' END AS cur FROM r)
SELECT k AS o_orderkey, position, CAST(lo AS BIGINT) AS low, CAST(hi AS BIGINT) AS high, cur AS currency, CASE position WHEN 0 THEN 'month' WHEN 1 THEN 'one_time' WHEN 2 THEN 'task' ELSE 'unknown' END AS period, CASE position WHEN 0 THEN 'base' WHEN 1 THEN 'task_reward' WHEN 2 THEN 'task_reward' ELSE 'unknown' END AS component, CASE position WHEN 1 THEN 'Brno' WHEN 2 THEN 'DE' END AS place FROM v WHERE cur IN ('EUR', 'CHF') AND (lo IS NOT NULL OR hi IS NOT NULL) AND NOT coalesce(lo > hi, FALSE)""",
)
def x16_scoped(spark, d):
    """Four ranges for each order: a base salary, pay once in a city, pay by the task in a country, and one whose title names no place exactly."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    cents = lambda c: (F.col(c) * 100).cast("string")
    currency = F.when(k % 4 == 0, " eur").when(k % 4 == 1, "CHF").when(k % 4 == 2, "JPY").otherwise("euros")
    one = lambda period, title, high: F.struct(cents("o_custkey").alias("min"), high.alias("max"), currency.alias("currency"), F.lit(period).alias("period"), F.lit(title).alias("title"))
    ranges = F.array(one("Monthly", "Base salary, Brno", cents("o_orderkey")), one("one-time", "BRNO", F.lit(None).cast("string")), one("task", "Deutschland", cents("o_orderkey")), one(None, "Brno and around", cents("o_orderkey")))
    out = X.scoped_offers(o.withColumn("ranges", ranges), "o_orderkey", "ranges", COUNTRY_ALIASES, CITY_ALIASES, minor=True)
    return out.select("o_orderkey", "position", F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"), "currency", "period", "component", "place")


# --- selection and profiles --------------------------------------------------------------------------------------------------------


def candidates(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("job"), F.col("l_returnflag").alias("value"), F.col("l_quantity").cast("int").alias("score"), F.when(F.col("l_linenumber") != 2, F.col("l_linestatus") == "F").alias("active"), F.concat_ws(":", "l_partkey", "l_suppkey", "l_linenumber").alias("evidence_id"))


@query("w04_select_fact", "WITH c AS (SELECT l_orderkey AS job, l_returnflag AS v, (CAST(l_quantity AS INT), CASE WHEN l_linestatus = 'F' OR l_linenumber = 2 THEN 1 ELSE 0 END) AS r FROM lineitem), b AS (SELECT job, max(r) AS r FROM c GROUP BY 1), t AS (SELECT c.job, min(v) AS lo, max(v) AS hi FROM c JOIN b ON c.job = b.job AND c.r = b.r GROUP BY 1) SELECT job, CASE WHEN lo = hi THEN 'known' ELSE 'conflict' END AS state, CASE WHEN lo = hi THEN lo END AS value, (SELECT count(DISTINCT (l_partkey, l_suppkey, l_linenumber)) FROM lineitem WHERE l_orderkey = job) AS n_evidence FROM t")
def w04(spark, d):
    return P.select_fact(candidates(spark, d), ["job"]).select("job", "state", "value", F.size("evidence_ids").cast("long").alias("n_evidence"))


@query("w05_select_description", f"WITH q AS (SELECT doc_id, lang, {QUALITY} AS quality, length(text) AS n FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang, n % 1000 ORDER BY CASE quality WHEN 'complete' THEN 4 WHEN 'short' THEN 2 WHEN 'snippet' THEN 1 ELSE 0 END DESC, CASE WHEN doc_id % 5 <> 0 OR doc_id % 2 = 0 THEN 1 ELSE 0 END DESC, n DESC, doc_id DESC) AS place FROM q) SELECT doc_id, place, place = 1 AND quality NOT IN ('empty', 'template') AS selected FROM r")
def w05(spark, d):
    c = table(spark, d, "documents").select("doc_id", F.struct("lang", F.length("text") % 1000).alias("job"), X.description_quality(F.col("text"), F.col("source"), ("src3",)).alias("quality"), F.when(F.col("doc_id") % 5 != 0, True).when(F.col("doc_id") % 2 != 0, False).alias("active"), F.lit(0).alias("native"), F.length("text").alias("length"), F.lit("s").alias("source"), F.col("doc_id").alias("id"))
    return P.select_description(c, "job").select("doc_id", "place", "selected")


@query("w06_order_locations", "WITH b AS (SELECT l_orderkey, l_suppkey AS place, l_suppkey % 4 AS country, max(l_linenumber) AS s FROM lineitem GROUP BY 1, 2, 3), t AS (SELECT *, max(s) OVER (PARTITION BY l_orderkey) AS top FROM b) SELECT l_orderkey, string_agg(place, ',' ORDER BY s DESC, place) AS places, count(DISTINCT country) FILTER (WHERE s = top) > 1 AS country_conflict FROM t GROUP BY 1")
def w06(spark, d):
    loc = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("place"), (F.col("l_suppkey") % 4).alias("country"), F.col("l_linenumber").alias("score"))
    return P.order_locations(loc, "l_orderkey").select("l_orderkey", F.array_join("places", ",").alias("places"), "country_conflict")


@query("r06_build_evidence", "SELECT count(DISTINCT (l_orderkey, l_returnflag)) AS n FROM lineitem")
def r06(spark, d):
    e = P.build_evidence(table(spark, d, "lineitem").select("l_orderkey", "l_returnflag"), ["l_orderkey", "l_returnflag"])
    return e.agg(F.count_distinct("evidence_id").alias("n"))


@query("r06_evidence_rows", """SELECT l_orderkey, l_returnflag, min(l_quantity) >= 0 AS positive, sha256('{"l_orderkey":"' || l_orderkey || '","l_returnflag":"' || l_returnflag || '"}') AS evidence_id FROM lineitem GROUP BY 1, 2""")
def r06_rows(spark, d):
    """The pieces of evidence themselves, each once, with the id that their content gives."""
    li = table(spark, d, "lineitem")
    e = P.build_evidence(li.select("l_orderkey", "l_returnflag", (F.col("l_quantity") >= 0).alias("positive")), ["l_orderkey", "l_returnflag"])
    return e.select("l_orderkey", "l_returnflag", "positive", "evidence_id")


def prints(docs, version="1"):
    return P.fingerprint(docs, "doc_id", ["lang", "source"], "text", {"rules": version})


@query("r07_fingerprint", """WITH s AS (SELECT l_orderkey AS doc_id, sha256('{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}') AS d FROM lineitem)
SELECT doc_id, sha256('{"lang":"' || lang || '","source":"' || source || '"}') AS metadata_hash, sha256(text) AS text_hash, coalesce((SELECT sha256(string_agg(d, '|' ORDER BY d)) FROM s WHERE s.doc_id = documents.doc_id), sha256('')) AS sources_hash, sha256('rules=1') AS version_hash FROM documents""")
def r07(spark, d):
    sources = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_linenumber", "l_partkey")
    out = P.fingerprint(table(spark, d, "documents"), "doc_id", ["lang", "source"], "text", {"rules": "1"}, sources, ["l_partkey", "l_linenumber"])
    return out.select("doc_id", "metadata_hash", "text_hash", "sources_hash", "version_hash")


def fact_rows(spark, d):
    """Languages chosen from two candidates of each document, the better one of them true; sources that contradict each other."""
    docs = table(spark, d, "documents")
    quality = X.description_quality(F.col("text"), F.col("source"), ("src3",))
    jobs = docs.select("doc_id", quality.alias("quality"))
    own = docs.select("doc_id", F.lit("lang").alias("field"), F.col("lang").alias("value"), F.lit(50).alias("score"), F.lit(None).cast("boolean").alias("active"), F.concat(F.lit("e"), "doc_id").alias("evidence_id")).where("doc_id % 3 <> 0")
    other = own.withColumns({"value": F.lit("xx"), "active": F.lit(False), "evidence_id": F.concat(F.lit("f"), "doc_id")})
    torn = docs.where("doc_id % 4 = 1").select("doc_id", F.lit("source").alias("field"), F.explode(F.array(F.col("source"), F.lit("else"))).alias("value"), F.lit(40).alias("score"), F.lit(True).alias("active"), F.concat(F.lit("g"), "doc_id").alias("evidence_id"))
    return jobs, P.select_fact(own.unionByName(other).unionByName(torn), ["doc_id", "field"])


PROFILE = f"p AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 'known' WHEN q = 'complete' THEN 'not_mentioned' ELSE 'insufficient_content' END AS lang_state, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang_value, CASE WHEN doc_id % 4 = 1 THEN 'conflict' WHEN q = 'complete' THEN 'not_mentioned' ELSE 'insufficient_content' END AS source_state FROM (SELECT *, {QUALITY} AS q FROM documents))"


PARTS = """o AS (SELECT l_orderkey AS doc_id, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS offers FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'N' THEN 2 ELSE 1 END DESC) AS r FROM lineitem WHERE l_returnflag <> 'A') WHERE r = 1 GROUP BY 1),
b AS (SELECT l_orderkey AS doc_id, l_suppkey AS place, max(l_linenumber) AS s FROM lineitem GROUP BY 1, 2), l AS (SELECT doc_id, string_agg(place, ',' ORDER BY s DESC, place) AS places FROM b GROUP BY 1)"""


@query("r08_assemble_profiles", f"WITH {PROFILE}, {PARTS} SELECT p.*, CASE WHEN doc_id % 3 <> 0 THEN 'e' || doc_id END AS lang_evidence, offers, places FROM p LEFT JOIN o USING (doc_id) LEFT JOIN l USING (doc_id)")
def r08(spark, d):
    """Facts as selected (W04), whole offer sets of the best source, places in order of their evidence."""
    jobs, facts = fact_rows(spark, d)
    li = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "doc_id")
    offers = P.choose_offers(li.where("l_returnflag <> 'A'").select("doc_id", F.col("l_returnflag").alias("source_name"), F.when(F.col("l_returnflag") == "N", 2).otherwise(1).alias("score"), F.col("l_partkey").cast("string").alias("part")), "doc_id", ["part"])
    places = P.order_locations(li.select("doc_id", F.col("l_suppkey").alias("place"), F.lit("CZ").alias("country"), F.col("l_linenumber").alias("score")), "doc_id")
    p = P.assemble_profiles(facts, jobs, "doc_id", ["lang", "source"], offers, places)
    return p.select("doc_id", F.col("profile.lang.state").alias("lang_state"), F.col("profile.lang.value").alias("lang_value"), F.col("profile.source.state").alias("source_state"), F.get("profile.lang.evidence_ids", F.lit(0)).alias("lang_evidence"), F.array_join(F.transform("profile.offers", lambda x: x["part"]), ",").alias("offers"), F.array_join("profile.places", ",").alias("places"))


@query("e03_prediction_view", f"WITH {PROFILE} SELECT doc_id, 'lang' AS field, lang_state AS state, lang_value AS value FROM p UNION ALL SELECT doc_id, 'source', source_state, NULL FROM p")
def e03(spark, d):
    jobs, facts = fact_rows(spark, d)
    return E.prediction_view(P.assemble_profiles(facts, jobs, "doc_id", ["lang", "source"]), "doc_id", ["lang", "source"])


@query("e01_coverage_baseline", f"WITH {PROFILE}, v AS (SELECT 'lang' AS field, lang_state AS s, CASE doc_id % 4 WHEN 0 THEN 'parsed' WHEN 1 THEN 'provider' WHEN 2 THEN 'suggestion' ELSE 'native' END AS m FROM p UNION ALL SELECT 'source', source_state, NULL FROM p) SELECT field, count(*) FILTER (WHERE s = 'known' AND m = 'native') AS native, count(*) FILTER (WHERE s = 'known' AND m = 'parsed') AS parsed, count(*) FILTER (WHERE s = 'known' AND m = 'provider') AS provider, count(*) FILTER (WHERE s = 'known' AND m = 'suggestion') AS suggestion, count(*) FILTER (WHERE s NOT IN ('known', 'conflict')) AS unknown, count(*) FILTER (WHERE s = 'conflict') AS conflict FROM v GROUP BY 1")
def e01(spark, d):
    jobs, facts = fact_rows(spark, d)
    method = F.element_at(F.array(*map(F.lit, ("parsed", "provider", "suggestion", "native"))), (F.col("doc_id") % 4 + 1).cast("int"))
    evidence = table(spark, d, "documents").select(F.concat(F.lit("e"), "doc_id").alias("evidence_id"), method.alias("method"))
    return E.coverage_baseline(P.assemble_profiles(facts, jobs, "doc_id", ["lang", "source"]), "doc_id", ["lang", "source"], evidence)


@query("g17_coverage_matrix", "SELECT source AS field, count(*) FILTER (WHERE k = 0) AS native, count(*) FILTER (WHERE k = 1) AS parsed, count(*) FILTER (WHERE k = 2) AS provider, count(*) FILTER (WHERE k = 3) AS suggestion, count(*) FILTER (WHERE k = 4) AS unknown, count(*) FILTER (WHERE k = 5) AS conflict FROM (SELECT source, n_chars % 6 AS k FROM documents) GROUP BY 1")
def g17(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("native", "parsed", "provider", "suggestion", "unknown", "conflict"))), (F.col("n_chars") % 6 + 1).cast("int"))
    return P.coverage_matrix(table(spark, d, "documents").select(F.col("source").alias("field"), kind.alias("kind")))


@query("r09_layers_to_run", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'text,selection,profile' WHEN 2 THEN 'native,selection,profile' ELSE 'native,text,selection,profile' END AS layers FROM documents")
def r09(spark, d):
    docs = table(spark, d, "documents")
    k = F.col("doc_id") % 4
    old = docs.where(k != 3).withColumn("text", F.when(k == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).withColumn("lang", F.when(k == 2, F.lit("xx")).otherwise(F.col("lang")))
    return P.layers_to_run(prints(docs), prints(old), "doc_id").select("doc_id", F.array_join("layers", ",").alias("layers"))


@query("r10_publish_versions", "WITH v AS (SELECT n_chars % 997 AS job, lang AS input_hash, min(doc_id) AS created_at FROM documents GROUP BY 1, 2) SELECT job, arg_max(input_hash, (created_at, input_hash)) AS input_hash, job % 10 = 1 AS stale FROM v WHERE job % 10 <> 0 GROUP BY 1")
def r10(spark, d):
    """Versions of the English and German documents are there; those of all languages come in. A tenth of the jobs is deleted, a tenth merged."""
    v = table(spark, d, "documents").groupBy((F.col("n_chars") % 997).alias("job"), F.col("lang").alias("input_hash")).agg(F.min("doc_id").alias("created_at"))
    jobs = v.select("job").distinct()
    return P.publish_versions(v.where("input_hash IN ('en', 'de')"), v, "job", jobs.where("job % 10 = 0"), jobs.where("job % 10 = 1"))[1]


@query("r11_check_profiles", """SELECT doc_id, CASE WHEN doc_id % 9 = 5 THEN 'country' ELSE 'lang' END AS field, CASE doc_id % 9 WHEN 0 THEN 'known_without_value' WHEN 1 THEN 'known_without_evidence' WHEN 2 THEN 'value_without_knowledge' WHEN 3 THEN 'dangling_evidence' WHEN 4 THEN 'span_out_of_order' WHEN 5 THEN 'no_iso_country' WHEN 6 THEN 'years_out_of_order' ELSE 'duplicate_evidence' END AS problem FROM documents WHERE doc_id % 9 < 8""")
def r11(spark, d):
    from tablewright.sources.dimensions import load_dimension

    docs, k = table(spark, d, "documents"), F.col("doc_id") % 9
    own, other = F.concat(F.lit("e"), "doc_id"), F.lit("nowhere")
    state = F.when(k == 2, "unknown").when(k == 8, "conflict").otherwise("known")
    value = F.when(k == 0, F.lit(" ")).when(k == 5, "Czechia").when(k != 8, "CZ")
    ids = F.when(k == 1, F.array().cast("array<string>")).when(k == 3, F.array(other)).otherwise(F.array(own))
    facts = docs.select("doc_id", F.when(k == 5, "country").otherwise("lang").alias("field"), state.alias("state"), value.alias("value"), ids.alias("evidence_ids"), F.lit(3).alias("low"), F.when(k == 6, 2).otherwise(4).alias("high"))
    evidence = docs.select("doc_id", F.lit("lang").alias("field"), own.alias("evidence_id"), F.lit(2).alias("start"), F.when(k == 4, 1).otherwise(2).alias("end"))
    evidence = evidence.unionByName(evidence.where(k == 7))
    return P.check_profiles(facts, evidence, "doc_id", load_dimension(spark, "countries"), {"years": ("low", "high")})


# --- evaluation --------------------------------------------------------------------------------------------------------------------


def gold_and_predicted(spark, d):
    lab = table(spark, d, "labels")
    one = lambda c, name: F.when(c, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    gold = lab.select("doc_id", F.lit("flags").alias("field"), F.when(F.col("doc_id") % 10 == 0, "unknown").otherwise("known").alias("state"), F.concat(one(F.col("quality") == 1, "good"), one(F.col("toxic") == 1, "toxic")).alias("values"))
    docs = table(spark, d, "documents")
    bad = F.contains("text", F.lit("idiot"))
    predicted = docs.where("doc_id % 7 <> 0").select("doc_id", F.lit("flags").alias("field"), F.lit("known").alias("state"), F.concat(one(F.length("text") > 1000, "good"), one(bad, "toxic")).alias("values"))
    return gold, predicted


METRIC = """j AS (SELECT doc_id, quality = 1 AS gg, toxic = 1 AS gt, coalesce(length(text) > 1000 AND doc_id % 7 <> 0, false) AS pg, coalesce(contains(text, 'idiot') AND doc_id % 7 <> 0, false) AS pt FROM labels LEFT JOIN documents USING (doc_id) WHERE doc_id % 10 <> 0),
n AS (SELECT count(*) AS labeled, count(*) FILTER (WHERE pg OR pt) AS emitted, 0 AS conflicts, count(*) FILTER (WHERE gg AND pg) + count(*) FILTER (WHERE gt AND pt) AS tp, count(*) FILTER (WHERE pg AND NOT gg) + count(*) FILTER (WHERE pt AND NOT gt) AS fp, count(*) FILTER (WHERE gg AND NOT pg) + count(*) FILTER (WHERE gt AND NOT pt) AS fn FROM j)"""


@query("g18_label_metrics", f'WITH {METRIC} SELECT \'flags\' AS field, *, round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(emitted / labeled, 9) AS coverage FROM n')
def g18(spark, d):
    return E.label_metrics(*gold_and_predicted(spark, d), "doc_id")


@query("g19_language_metrics", 'WITH j AS (SELECT doc_id, lang AS g, CASE WHEN doc_id % 4 = 0 THEN \'en\' ELSE lang END AS p FROM documents), n AS (SELECT count(*) AS labeled, count(*) AS emitted, 0 AS conflicts, count(*) FILTER (WHERE g = p) AS tp, count(*) FILTER (WHERE g <> p) AS fp, count(*) FILTER (WHERE g <> p) AS fn FROM j) SELECT \'presence\' AS field, *, round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, 1.0 AS coverage FROM n')
def g19(spark, d):
    docs = table(spark, d, "documents")
    side = lambda c: docs.select("doc_id", F.lit("languages").alias("field"), F.lit("known").alias("state"), F.array(F.concat(c, F.lit(":required:"))).alias("values"))
    return E.language_metrics(side(F.col("lang")), side(F.when(F.col("doc_id") % 4 == 0, "en").otherwise(F.col("lang"))), "doc_id", "presence")


@query("e04_label_tokens", "SELECT l_orderkey, string_agg(DISTINCT t, ',' ORDER BY t) AS tokens FROM (SELECT l_orderkey, l_returnflag || ':' || l_linestatus AS t FROM lineitem) GROUP BY 1")
def e04(spark, d):
    v = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_returnflag", "l_linestatus")).alias("v"))
    return v.select("l_orderkey", F.array_join(E.label_tokens(F.col("v"), ["l_returnflag", "l_linestatus"]), ",").alias("tokens"))


@query("s18_label_unpivot", "SELECT doc_id, 'quality' AS field, 'known' AS state, CAST(quality AS VARCHAR) AS value FROM labels UNION ALL SELECT doc_id, 'toxic', CASE WHEN toxic = 1 THEN 'known' ELSE 'not_mentioned' END, CASE WHEN toxic = 1 THEN '1' END FROM labels UNION ALL SELECT doc_id, 'added', 'unlabeled', NULL FROM labels")
def s18(spark, d):
    wide = table(spark, d, "labels").select("doc_id", F.lit("known").alias("quality_state"), F.col("quality").alias("quality_value"), F.when(F.col("toxic") == 1, "known").otherwise("not_mentioned").alias("toxic_state"), F.when(F.col("toxic") == 1, F.lit(1)).alias("toxic_value"))
    return E.unpivot_labels(wide, "doc_id", ["quality", "toxic", "added"])


@query("e05_check_labels", """SELECT doc_id, CASE WHEN doc_id % 8 = 3 THEN 'period' WHEN doc_id % 8 = 4 THEN 'years' ELSE 'f' END AS field, CASE doc_id % 8 WHEN 0 THEN 'unknown_state' WHEN 1 THEN 'known_without_value' WHEN 2 THEN 'value_without_knowledge' WHEN 3 THEN 'unknown_period' WHEN 4 THEN 'years_out_of_range' WHEN 5 THEN 'reviewer_missing' ELSE 'duplicate_label' END AS problem FROM labels WHERE doc_id % 8 < 7""")
def e05(spark, d):
    k = F.col("doc_id") % 8
    lab = table(spark, d, "labels").select("doc_id", F.when(k == 3, "period").when(k == 4, "years").otherwise("f").alias("field"), F.when(k == 0, "maybe").when(k == 2, "unknown").otherwise("known").alias("state"), F.when(k == 3, "fortnight").when(k == 0, F.lit(None)).when(k != 1, F.lit("v")).alias("value"), F.lit(3).alias("low"), F.when(k == 4, 70).otherwise(5).alias("high"), F.when(k != 5, "r").alias("reviewer_id"))
    return E.check_labels(lab.unionByName(lab.where(k == 6)), "doc_id", words=E.LABEL_WORDS, ranges={"years": ("low", "high", 60)}, reviewers=True)


@query("j20_labels_with_predictions", "SELECT doc_id, toxic, contains(text, 'idiot') AS prediction, doc_id % 5 = 0 AS stale FROM labels JOIN documents USING (doc_id)")
def j20(spark, d):
    docs = table(spark, d, "documents")
    lab = table(spark, d, "labels").join(docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.md5(F.lit("old"))).otherwise(F.md5("text")).alias("input_hash")), "doc_id")
    pred = docs.select("doc_id", F.md5("text").alias("input_hash"), F.contains("text", F.lit("idiot")).alias("prediction"))
    return E.labels_with_predictions(lab, pred, "doc_id").select("doc_id", "toxic", "prediction", "stale")


@query("e06_metrics", f"""WITH {METRIC}, k AS (SELECT lang AS g, CASE WHEN doc_id % 4 = 0 THEN 'en' ELSE lang END AS p FROM documents), q AS (SELECT count(*) AS labeled, count(*) FILTER (WHERE g = p) AS tp, count(*) FILTER (WHERE g <> p) AS fp, count(*) FILTER (WHERE g <> p) AS fn FROM k)
SELECT 'flags' AS field, labeled, tp, fp, fn FROM n UNION ALL SELECT 'languages_' || unnest(['presence', 'requirement']), labeled, tp, fp, fn FROM q UNION ALL SELECT 'languages_cefr', labeled, 0, 0, 0 FROM q""")
def e06(spark, d):
    gold, predicted = gold_and_predicted(spark, d)
    docs = table(spark, d, "documents")
    side = lambda c: docs.select("doc_id", F.lit("languages").alias("field"), F.lit("known").alias("state"), F.array(F.concat(c, F.lit(":required:"))).alias("values"))
    gold, predicted = gold.unionByName(side(F.col("lang"))), predicted.unionByName(side(F.when(F.col("doc_id") % 4 == 0, "en").otherwise(F.col("lang"))))
    return E.evaluation_report(gold, predicted, "doc_id").select("field", "labeled", "tp", "fp", "fn")


@query("g20_cohort_manifest", "SELECT 'lang' AS stratum, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'population', (SELECT sha256(string_agg(p, '' ORDER BY part)) FROM (SELECT CAST('0x' || substr(h, 1, 8) AS BIGINT) % 1024 AS part, sha256(string_agg(h, '' ORDER BY h)) AS p FROM (SELECT DISTINCT sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents) GROUP BY 1)), count(DISTINCT doc_id) FROM documents")
def g20(spark, d):
    docs = table(spark, d, "documents")
    whole = E.population_hash(docs, "doc_id").select(F.lit("population").alias("stratum"), F.col("population_hash").alias("value"), "n")
    return E.cohort_manifest(docs, ["lang", "source"]).unionByName(whole)


SAMPLE = "w AS (SELECT doc_id, source, round(1.0 / count(*) OVER (PARTITION BY lang) + 1.0 / count(*) OVER (PARTITION BY source), 9) AS w, sha256('seed' || doc_id) AS h FROM documents), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY w DESC, h) AS r FROM w) WHERE r <= 3), z AS (SELECT doc_id, w, h, 0 AS k FROM f UNION ALL SELECT doc_id, w, h, 1 FROM w WHERE doc_id NOT IN (SELECT doc_id FROM f))"


@query("t03_review_sample", f"WITH {SAMPLE} SELECT doc_id FROM z ORDER BY k, w DESC, h LIMIT 100")
def t03(spark, d):
    return E.review_sample(table(spark, d, "documents"), "doc_id", "source", ["lang", "source"], 100, 3, "seed")


@query("e02_frozen_cohort", f"""WITH r AS (SELECT doc_id FROM documents WHERE n_chars > 5000 ORDER BY sha256('seed' || doc_id) LIMIT 10), {SAMPLE.replace('FROM documents)', 'FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r))', 1)}, c AS (SELECT doc_id FROM z ORDER BY k, w DESC, h LIMIT 90)
SELECT doc_id, md5(text) AS input_hash, doc_id IN (SELECT doc_id FROM r) AS reserved FROM documents WHERE doc_id IN (SELECT doc_id FROM c UNION ALL SELECT doc_id FROM r)""")
def e02(spark, d):
    docs = table(spark, d, "documents").withColumn("input_hash", F.md5("text"))
    return E.freeze_cohort(docs, "doc_id", "source", ["lang", "source"], "input_hash", F.col("n_chars") > 5000, 10, 100, 3, "seed").select("doc_id", "input_hash", "reserved")


@query("t04_reserve_special", "SELECT doc_id FROM labels WHERE toxic = 1 ORDER BY sha256('s' || doc_id) LIMIT 10")
def t04(spark, d):
    return E.reserve_special(table(spark, d, "labels"), F.col("toxic") == 1, "doc_id", 10, "s")[0].select("doc_id")


# --- feeds -------------------------------------------------------------------------------------------------------------------------


def landed(spark, d, feed: str, change: dict | None = None, more: dict | None = None):
    """Orders as payloads of a feed: each canonical field at the first path that the feed knows for it; `change` gives fields other values, `more` paths further ones."""
    o = spread(table(spark, d, "orders"))
    values = {"id": F.col("o_orderkey").cast("string"), "title": F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("Job "), "o_orderkey")), "company": F.concat(F.lit("C"), "o_custkey"), "city": F.concat(F.lit("City "), F.col("o_custkey") % 7), "country": F.lit("CZ"), "mode": F.when(F.col("o_orderkey") % 2 == 0, "Remote").otherwise("On-site"), "published": F.date_format("o_orderdate", "yyyy-MM-dd")}

    def nested(paths: dict):
        tree: dict = {}
        for path, value in paths.items():
            at = tree
            *front, last = [p for p in path.removeprefix("$.").split(".")]
            for p in front:
                at = at.setdefault(p, {})
            at[last] = value
        build = lambda t: F.struct(*[(F.array(build_or(v)) if k.endswith("[0]") else build_or(v)).alias(k.removesuffix("[0]")) for k, v in t.items()])
        build_or = lambda v: build(v) if isinstance(v, dict) else v
        return build(tree)

    paths: dict = dict(more or {})
    values["url"] = F.concat(F.lit("https://jobs.example.com/"), "o_orderkey")
    values |= change or {}
    for field, value in values.items():
        for p in S.FEEDS[feed][field][:1]:
            paths.setdefault(p, F.col("o_orderkey") % 2 == 0 if p == "$.location.remote" else value)
    return o.select(F.lit("scope").alias("scope"), F.to_json(nested(paths)).alias("body"))


FEED_SQL = "SELECT CAST(o_orderkey AS VARCHAR) AS native_id, CASE WHEN o_orderkey % 9 <> 0 THEN 'Job ' || o_orderkey ELSE 'Unknown position' END AS title, 'C' || o_custkey AS company, 'City ' || (o_custkey % 7) || ', CZ' AS location_text, CASE WHEN o_orderkey % 2 = 0 THEN 'remote' ELSE 'onsite' END AS remote_type, strftime(o_orderdate, '%Y-%m-%d') AS published FROM orders"


def feed_query(feed: str, number: int):
    def run(spark, d):
        out = S.project_canonical(landed(spark, d, feed), feed)
        return out.select("native_id", "title", "company", "location_text", "remote_type", F.date_format("published_at", "yyyy-MM-dd").alias("published"))

    sql = FEED_SQL
    if feed == "greenhouse_direct":  # its place label also states the mode
        sql = FEED_SQL.replace("CASE WHEN o_orderkey % 2 = 0 THEN 'remote' ELSE 'onsite' END AS remote_type", "'unknown' AS remote_type")
    if feed in ("smartrecruiters_direct", "fantastic_jobs_apify"):  # the first says remote or nothing; so does the second's first field
        sql = FEED_SQL.replace("'onsite'", "'unknown'") if feed == "smartrecruiters_direct" else FEED_SQL
    Q[f"s{number:02d}_p01_{feed}"] = (run, sql)


for _n, _feed in ((2, "smartrecruiters_direct"), (3, "greenhouse_direct"), (4, "workable_direct"), (5, "ashby_direct"), (6, "lever_direct"), (7, "workday_direct"), (8, "successfactors_direct"), (9, "fantastic_jobs_apify"), (10, "jooble_direct")):
    feed_query(_feed, _n)


@query("s08_page_details", r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html[^>]*lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def s08(spark, d):
    return HT.parse_detail(table(spark, d, "pages"), "page_id", "html").select("page_id", "title", "lang")


@query("s08_page_listing", "SELECT page_id, CAST(len(regexp_extract_all(html, '<a href=\"[^\"]*\">')) AS BIGINT) AS n FROM pages WHERE len(regexp_extract_all(html, '<a href=\"[^\"]*\">')) > 0")
def s08_listing(spark, d):
    return HT.parse_listing(table(spark, d, "pages"), "page_id", "html").groupBy("page_id").agg(F.count("*").alias("n"))


def career_pages(spark, d):
    """Pages with a posting of two places in nested scopes, a page label and fields of a career site around what they hold."""
    p = table(spark, d, "pages")
    title, host = F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    k = F.col("page_id")
    parts = [
        '<main><div itemscope itemtype="http://schema.org/JobPosting"><h1 itemprop="title"> ', title, ' <b>', F.lit(""), "</b></h1><script>itemprop</script>",
        '<div itemprop="jobLocation" itemscope itemtype="http://schema.org/Place"><p itemprop="address" itemscope><span itemprop="addressLocality">City ', (k % 7).cast("string"), '</span></p></div>',
        '<div itemprop="jobLocation" itemscope itemtype="http://schema.org/Place"><span itemprop="addressLocality">Town ', (k % 3).cast("string"), "</span></div>",
        '<meta itemprop="datePosted" content="2024-01-', F.lpad((k % 28 + 1).cast("string"), 2, "0"), '"><div itemprop="hiringOrganization" itemscope><i itemprop="name">', host, "</i></div></div></main>",
        '<span class="paginationLabel">Results <b>', (k * 25 + 1).cast("string"), " - ", (k * 25 + 25).cast("string"), "</b> of <b>", (k * 25 + 90).cast("string"), "</b></span>",
        '<p data-careersite-propertyid="city">Town <i>', (k % 3).cast("string"), '</i></p><p data-careersite-propertyid="empty"> </p>',
    ]
    extra = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    return p.select("page_id", F.concat(extra, F.col("html")).alias("html"))


# The parser resolves references as HTML does, also those that a cut title leaves without their semicolon; the SQL states it for the five that escaping writes.
@query("s08_page_items", r"""SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&#(x27|39);?', '''', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'), '^ | $', '', 'g')), '') AS title, '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS posted, regexp_extract(url, '^https?://([^/?#]+)', 1) AS company, 'City ' || (page_id % 7) || '|Town ' || (page_id % 3) AS places FROM pages""")
def s08_items(spark, d):
    """Each page's posting out of its nested scopes: the place's names are not the posting's."""
    items = HT.item_records(career_pages(spark, d), "page_id", "html")
    return HT.postings(items, "page_id").select("page_id", "title", "posted", "company", F.array_join("places", "|").alias("places"))


@query("s08_page_range", "SELECT page_id, page_id * 25 + 1 AS first, page_id * 25 + 25 AS last, page_id * 25 + 90 AS total FROM pages")
def s08_range(spark, d):
    out = HT.page_range(career_pages(spark, d), "page_id", "html")
    return out.select("page_id", *[F.col(c).cast("long").alias(c) for c in ("first", "last", "total")])


@query("s08_page_properties", "SELECT page_id, 'city' AS property, 'Town ' || (page_id % 3) AS value FROM pages")
def s08_properties(spark, d):
    return HT.page_properties(career_pages(spark, d), "page_id", "html").select("page_id", "property", "value")


@query("p11_route_invalid", "SELECT CASE WHEN doc_id % 10 = 0 THEN 'missing_identity' WHEN length(text) < 20 THEN 'missing_title' ELSE 'good' END AS route, count(*) AS n FROM documents GROUP BY 1")
def p11(spark, d):
    docs = table(spark, d, "documents").withColumn("native_id", F.when(F.col("doc_id") % 10 != 0, F.col("doc_id")))
    good, bad = S.route_invalid(docs, [(F.col("native_id").isNull(), "missing_identity"), (F.length("text") < 20, "missing_title")])
    return good.select(F.lit("good").alias("route")).unionByName(bad.select(F.col("reject_reason").alias("route"))).groupBy("route").agg(F.count("*").alias("n"))


@query("p12_only_listed", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL OR toxic = 0")
def p12(spark, d):
    lab = table(spark, d, "labels").select("doc_id", (F.col("toxic") == 0).alias("listed"))
    return S.only_listed(table(spark, d, "documents").select("doc_id").join(lab, "doc_id", "left"), F.col("listed")).select("doc_id")


@query("m02_changed_jobs", "SELECT DISTINCT l_orderkey AS job_id FROM lineitem WHERE l_suppkey % 10 = 0")
def m02(spark, d):
    from tablewright.streaming.jobs import changed_jobs

    line = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    li = table(spark, d, "lineitem").select(F.lit("s").alias("source_name"), line.alias("source_job_id"), F.col("l_orderkey").alias("job_id"), F.lit("u").alias("source_url"), F.lit(True).alias("is_active"), F.col("l_suppkey").cast("string").alias("payload_hash")).distinct()
    after = li.withColumn("payload_hash", F.when(F.col("payload_hash").cast("int") % 10 == 0, F.lit("changed")).otherwise(F.col("payload_hash")))
    return changed_jobs(li, after)

# --- files ----------------------------------------------------------------------------------------------------------------------------


def landing_files(spark, d, feed="lever_direct"):
    """The orders as landed files: one json object for each record, and for every hundredth a line that is none."""
    from tablewright.storage import scratch

    path = scratch(spark, "landing")
    o = landed(spark, d, feed)
    line = F.to_json(F.struct(F.lit(feed).alias("source_name"), "scope", F.lit("run").alias("run_id"), F.lit(1).alias("page_no"), F.lit("2024-01-01T00:00:00").alias("fetched_at"), "body"))
    key = F.get_json_object("body", "$.id").cast("long")
    o.select(F.when(key % 100 == 0, F.concat(F.lit("{broken "), key)).otherwise(line).alias("value")).write.option("compression", "gzip").text(path)
    return path


@query("s01_read_landing", "SELECT CASE WHEN o_orderkey % 100 = 0 THEN 'corrupt' ELSE 'record' END AS kind, count(*) AS n, sum(CASE WHEN o_orderkey % 100 <> 0 THEN o_orderkey ELSE 0 END) AS keys FROM orders GROUP BY 1")
def s01(spark, d):
    rows = S.read_landing(spark, landing_files(spark, d))
    key = F.coalesce(F.get_json_object("body", "$.id").cast("long"), F.lit(0))
    return rows.groupBy(F.when(F.col("body").isNull(), "corrupt").otherwise("record").alias("kind")).agg(F.count("*").alias("n"), F.sum(key).alias("keys"))


@query("s02_listing_details", "SELECT CAST(o_orderkey AS VARCHAR) AS native_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Detail ' ELSE 'Listed ' END || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'remote' ELSE 'unknown' END AS remote_type, (SELECT count(*) FROM orders i WHERE i.o_custkey = orders.o_custkey) AS stated_total FROM orders")
def s02_details(spark, d):
    """A customer's orders as one listing page; every third has a detail page."""
    o = table(spark, d, "orders")
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("Listed "), "o_orderkey").alias("name"))
    pages = o.groupBy(F.col("o_custkey").cast("string").alias("scope")).agg(F.to_json(F.struct(F.count("*").alias("totalFound"), F.collect_list(record).alias("content"))).alias("body"))
    detail = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("Detail "), "o_orderkey").alias("name"), F.struct((F.col("o_orderkey") % 2 == 0).alias("remote")).alias("location"))
    details = o.where("o_orderkey % 3 = 0").select(F.col("o_custkey").cast("string").alias("scope"), F.to_json(detail).alias("body"))
    listed = S.listed_records(pages, "smartrecruiters_direct")
    good, _ = S.check_records(listed, "smartrecruiters_direct")
    out = S.project_with_details(good, details, "smartrecruiters_direct")
    return out.join(good.select("scope", "stated_total").distinct(), "scope").select("native_id", "title", "remote_type", "stated_total")


@query("s09_posted_after", "SELECT CAST(o_orderkey AS VARCHAR) AS native_id FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def s09_recent(spark, d):
    rows = S.project_canonical(landed(spark, d, "fantastic_jobs_apify"), "fantastic_jobs_apify")
    return S.posted_after(rows, F.lit("2000-01-01").cast("timestamp")).select("native_id")


@query("s14_run_ledger", "SELECT event_type AS source_name, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, count(*) AS runs, CAST(sum(n) AS BIGINT) AS records FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1, 2")
def s14(spark, d):
    """The ledger in two appends, read back."""
    from tablewright.storage import scratch

    path = scratch(spark, "runs")
    e = table(spark, d, "events").groupBy(F.col("event_type").alias("source_name"), "user_id").agg(F.count("*").alias("records_fetched"))
    runs = e.withColumn("status", F.when(F.col("source_name") == "error", "failed").otherwise("success"))
    for part in (runs.where("user_id % 2 = 0"), runs.where("user_id % 2 = 1")):
        S.append_run(path, part)
    return spark.read.parquet(path).groupBy("source_name", "status").agg(F.count("*").alias("runs"), F.sum("records_fetched").alias("records"))


@query("s16_report", "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def s16(spark, d):
    """A report written as json and as csv, read back from both."""
    from tablewright.storage import scratch

    path = scratch(spark, "report")
    S.write_report({"coverage": table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))}, path)
    kind = "source string, lang string, n long"
    as_json = spark.read.schema(kind).json(f"{path}/coverage.json")
    return as_json.intersect(spark.read.schema(kind).option("header", True).csv(f"{path}/coverage.csv"))


@query("s18_read_labels", "SELECT CAST(doc_id AS VARCHAR) AS job_id, 'quality' AS field, 'known' AS state, CAST(quality AS VARCHAR) AS value FROM labels UNION ALL SELECT CAST(doc_id AS VARCHAR), 'toxic', 'unlabeled', NULL FROM labels")
def s18_files(spark, d):
    """Labels written as json lines of an older version that lacks a field."""
    from tablewright.storage import scratch

    path = scratch(spark, "labels") + ".jsonl"
    label = F.struct(F.lit("known").alias("state"), F.col("quality").cast("string").alias("value"), F.lit(None).cast("string").alias("notes"))
    table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("job_id"), F.create_map(F.lit("quality"), label).alias("labels")).write.json(path)
    return E.read_labels(spark, path, ["quality", "toxic"]).select("job_id", "field", "state", "value")


@query("m01_ingest_stream", "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders WHERE o_orderkey % 100 <> 0")
def m01(spark, d):
    """The stream over the landed files, run to their end twice: the second run finds nothing new."""
    from tablewright.storage import scratch
    from tablewright.streaming.jobs import start_ingest_stream

    landing, store, checkpoint = landing_files(spark, d), scratch(spark, "store"), scratch(spark, "progress")
    for _ in range(2):
        start_ingest_stream(spark, landing, store, checkpoint).awaitTermination()
    return spark.read.parquet(store).agg(F.count("*").alias("n"), F.count_distinct("source_job_id").alias("ids"))
