"""Rules on tiny frames."""

import datetime as dt
import json
import random
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright import storage
from tablewright.functions import text as T
from tablewright.functions import values as V
from tablewright.functions.word_similarity import best_run, word_similarity
from tablewright.operators import extraction as X
from tablewright.operators import freshness as H
from tablewright.operators import html_text as HT
from tablewright.operators import lifecycle as C
from tablewright.operators import linkage as L
from tablewright.operators import merging as M
from tablewright.operators import places as PL
from tablewright.operators import profiles as P
from tablewright.sources import landing as S
from tablewright.sources.dimensions import CITY_ALIASES, COUNTRY_ALIASES, REGION_ALIASES, check_dimension, check_policies, load_dimension
from tablewright.streaming import jobs as streams


def one(spark, column, *values, schema="a string"):
    names = [c.split()[0] for c in schema.split(", ")]
    return [r[0] for r in spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema).select(column(*[F.col(n) for n in names])).collect()]


def test_company_keys(spark):
    names = ["2N TELEKOMUNIKACE a.s.", "Žluťoučký kůň, s.r.o.", "ACME Ltd", "Straße GmbH", "", None, "s.r.o."]
    assert one(spark, T.normalize_company, *names) == ["2n telekomunikace", "zlutoucky kun", "acme", "strasse", "", "", "s r o"]


def test_folds_differ(spark):
    assert one(spark, T.fold, "Łódź Straße") == ["łodz straße"]
    assert one(spark, T.ascii_fold, "Łódź Straße") == ["odz strae"]
    assert one(spark, T.normalize_text, "Łódź Straße") == ["lodz strasse"]
    assert one(spark, T.exact_title_key, "Ｄata  Analyst ") == ["data analyst"]


def test_similarity(spark):
    rows = [("word", "two words"), ("", ""), ("abc", "abc"), (None, "x")]
    got = one(spark, T.similarity, *rows, schema="a string, b string")
    assert got[0] == pytest.approx(4 / 11) and got[1] == 0.0 and got[2] == 1.0


def ordered_trigrams(text):
    out = []
    for word in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split():
        padded = f"  {word} "
        out += [padded[i : i + 3] for i in range(len(padded) - 2)]
    return out


def best_extent(short, long):
    """Of all extents of the long text's trigrams that start and end at a shared one, the largest share, one by one."""
    want, row = set(ordered_trigrams(short)), ordered_trigrams(long)
    at = [i for i, t in enumerate(row) if t in want]
    return max((len(want & set(row[i : j + 1])) / len(want | set(row[i : j + 1])) for i in at for j in at if i <= j), default=0.0)


def test_word_similarity_has_a_direction(spark):
    pairs = [("word", "two words"), ("", "x"), ("same", "same"), (None, "a"), ("two words", "word")]
    assert one(spark, word_similarity, *pairs, schema="a string, b string") == pytest.approx([0.8, 0.0, 1.0, 0.0, best_extent("two words", "word")])


def test_location_ladder(spark):
    rows = [("", "brno"), ("brno", "brno"), ("brno", "brno center"), ("brno", "praha")]
    assert one(spark, V.location_similarity, *rows, schema="a string, b string") == [0.5, 1.0, 0.95, 0.0]


def test_timestamps(spark):
    values = ["2026-01-02T03:04:05+02:00", "2026-01-02", "Fri, 02 Jan 2026 03:04:05 +0000", "Fri Jan 02 03:04:05 UTC 2026", "soon", None]
    got = one(spark, V.parse_timestamp, *values)
    assert [g and g.isoformat() for g in got] == ["2026-01-02T01:04:05", "2026-01-02T00:00:00", "2026-01-02T03:04:05", "2026-01-02T03:04:05", None, None]


def test_url_identity_refuses_tricks(spark):
    urls = ["https://jobs.acme.com/x/12", "https://jobs.acme.com/x/..%2f12", "https://user@jobs.acme.com/x/12", "https://jobs.acme.com:8443/x/12", "ftp://jobs.acme.com/x/12", "https://evil.com/x/12", None]
    got = one(spark, lambda c: V.url_identity(c, r"^jobs\.acme\.com$", r"^/([a-z]+)/(\d+)$", "site", "posting"), *urls)
    assert got[0].posting == "12" and got[1:] == [None] * 6
    same = one(spark, lambda c: V.url_identity(c, r"^jobs\.acme\.com$", r"^/([a-z]+)/(\d+)$", "site", "posting"), "https://jobs.acme.com:443/x/12", "http://jobs.acme.com/x/12", " https://JOBS.acme.com/x/12?a#b ")
    assert [r and r.posting for r in same] == ["12", None, "12"]


def test_unique_match_needs_one_target(spark):
    c = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (2, 21), (3, None)], "p int, t int")
    got = {r.p: (r.t, r.ambiguous) for r in L.unique_match(c, "p", "t").collect()}
    assert got == {1: (10, False), 2: (None, True), 3: (None, False)}


def test_similar_pairs_equals_all_pairs(spark):
    words = ["senior data analyst", "data analyst", "senior data analyst ", "junior baker", "baker junior", "", None]
    rows = [(i, f"b{i % 2}", w) for i, w in enumerate(words * 3)]
    df = spark.createDataFrame(rows, "id int, block string, t string")
    got = {(r.a, r.b): round(r.similarity, 9) for r in L.similar_pairs(df, "block", "id", "t", 0.45).collect()}
    x, y = df.where("t IS NOT NULL").alias("x"), df.where("t IS NOT NULL").alias("y")
    every = x.join(y, F.col("x.block") == F.col("y.block")).where("x.id < y.id").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), T.similarity(F.col("x.t"), F.col("y.t")).alias("s"))
    assert got == {(r.a, r.b): round(r.s, 9) for r in every.where("s >= 0.45").collect()} and got


def test_reviewed_pairs_leave_in_either_orientation(spark):
    pairs = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "a int, b int")
    done = spark.createDataFrame([(2, 1, "rejected"), (3, 4, "pending")], "a int, b int, status string")
    assert {(r.a, r.b) for r in L.exclude_reviewed(pairs, done).collect()} == {(3, 4), (5, 6)}


def test_new_companies_are_made_once(spark):
    batch = spark.createDataFrame([(1, "Acme Ltd"), (2, "ACME"), (3, "New s.r.o."), (4, "new"), (5, "  ")], "k int, n string")
    companies = spark.createDataFrame([("b", "Acme", 2), ("a", "acme ltd", 1)], "id string, name string, created_at int")
    resolved, new = L.resolve_company(batch, "n", companies)
    ids = {r.k: r.company_id for r in resolved.collect()}
    assert ids[1] == ids[2] == "a" and ids[3] == ids[4] and ids[5] is None and new.count() == 1


def test_guarded_update(spark):
    cur = spark.createDataFrame([(1, "old", "unknown"), (2, "", "onsite"), (3, "old", "onsite")], "id int, title string, remote_type string")
    inc = spark.createDataFrame([(1, 100, "new", "remote"), (2, 100, M.FALLBACK_TITLE, None), (3, 300, None, None)], "id int, priority int, title string, remote_type string")
    back = spark.createDataFrame([(1, 300), (2, 300), (3, 300)], "id int, priority int")
    out = M.guarded_update(cur, inc, back, "id", ["title", "remote_type"], F.lit("2026-01-01").cast("timestamp"), ("title",))
    assert {r.id: (r.title, r.remote_type) for r in out.collect()} == {1: ("old", "remote"), 2: ("", "onsite"), 3: ("old", None)}


def test_merge_rejects_ties_and_shared_ends(spark):
    cand = spark.createDataFrame([(1, 2), (3, 4), (5, 6), (5, 7)], "a int, b int")
    pri = spark.createDataFrame([(1, 300), (2, 100), (3, 100), (4, 100), (5, 300), (6, 100), (7, 100)], "id int, priority int")
    plan = M.merge_plan(cand, pri)
    assert {(r.kept, r.removed): r.rejected for r in plan.collect()} == {(1, 2): None, (4, 3): "equal_priority", (5, 6): "shared_endpoint", (5, 7): "shared_endpoint"}
    jobs = spark.createDataFrame([(i, "t" if i == 2 else "") for i in range(1, 8)], "id int, title string")
    src = spark.createDataFrame([(10, 1), (20, 2)], "id int, job_id int")
    same, _, history = M.apply_merges(plan, jobs, src, ["title"], [], [])
    assert same.count() == 7 and history.count() == 1
    new, moved, _ = M.apply_merges(plan, jobs, src, ["title"], [], [], dry_run=False)
    assert {r.id: r.title for r in new.collect()}[1] == "t" and new.count() == 6 and {r.job_id for r in moved.collect()} == {1}


def test_absence_needs_a_complete_inventory(spark):
    src = spark.createDataFrame([("s", "a", "d", True), ("s", "b", "d", True), ("t", "c", "d", True), ("s", "e", "agg", True), ("s", "f", "d", False), ("s", "g", "d", None)], "scope string, key string, source_name string, is_active boolean").withColumn("last_seen_at", F.lit(None).cast("timestamp"))
    seen = spark.createDataFrame([("s", "a"), ("s", "f")], "scope string, key string")
    scopes = spark.createDataFrame([("s", True, True), ("t", True, False)], "scope string, successful boolean, complete boolean")
    out = C.reconcile_absence(src, seen, scopes, "scope", "key", ["d"], F.lit("2026-01-01").cast("timestamp"))
    assert {r.key: (r.change, r.is_active) for r in out.collect()} == {"a": ("observed", True), "b": ("deactivated", False), "c": ("unchanged", True), "e": ("unchanged", True), "f": ("reactivated", True), "g": ("deactivated", False)}


def test_unknown_activity_keeps_a_job_open(spark):
    jobs = spark.createDataFrame([(1, "inactive"), (2, "active"), (3, "expired")], "id int, status string").withColumn("last_seen_at", F.lit(None).cast("timestamp"))
    src = spark.createDataFrame([(1, "d", None), (2, "d", False)], "id int, source_name string, is_active boolean").withColumn("last_seen_at", F.lit(None).cast("timestamp"))
    assert {r.id: r.status for r in C.canonical_activity(jobs, src, "id", ["d"]).collect()} == {1: "active", 2: "inactive", 3: "expired"}


def test_select_fact_conflicts_only_at_the_top(spark):
    c = spark.createDataFrame([("a", "x", 50, True, "1"), ("a", "y", 40, True, "2"), ("b", "x", 50, True, "3"), ("b", "y", 50, True, "4"), ("c", "x", 50, False, "5"), ("c", "y", 50, True, "6")], "k string, value string, score int, active boolean, evidence_id string")
    got = {r.k: (r.state, r.value, r.evidence_ids) for r in P.select_fact(c, ["k"]).collect()}
    assert got["a"] == ("known", "x", ["1", "2"]) and got["b"][:2] == ("conflict", None) and got["c"][:2] == ("known", "y")


def test_spans_address_the_text(spark):
    text = "Ünï: Python, python!\nPythonic"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    rows = X.dictionary_mentions(docs, "id", "t", {"Python": "python"}).collect()
    assert sorted(text[r.start : r.end] for r in rows) == ["Python", "python"]


def test_clean_html():
    raw = "<nav>menu</nav><h1>Job</h1><ul><li>one<li>two</ul><p aria-hidden='true'>no</p><div class='cookie-banner'>no<div>no</div></div>a&amp;amp;b<script>if (a < b) '<p>'</script>"
    assert HT.shown(raw) == "Job\n- one\n- two\na&b"
    assert HT.shown(None) == "" and HT.shown("plain  text\r\n\r\nline") == "plain text\nline" and HT.shown("a < b<br/>c<p hidden>d</p><input hidden>e") == "a < b\nce"


def test_page_records(spark):
    html = '<span class="paginationLabel">Results <b>1 - 25</b> of <b>1,130</b></span><span data-careersite-propertyid="city"> Brno <i>2</i></span><div itemprop="datePosted">2026-01-02</div>'
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, h string")
    assert [tuple(r) for r in HT.page_range(pages, "id", "h").orderBy("id").collect()] == [(1, 1, 25, 1130), (2, None, None, None), (3, None, None, None)]
    assert [tuple(r) for r in HT.page_properties(pages, "id", "h").collect()] == [(1, 0, "city", "Brno 2")]
    assert HT.parse_detail(pages, "id", "h").orderBy("id").first().posted == "2026-01-02"


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id int, t string")


def test_language_requirements(spark):
    text = "Fluent English required; German B2 or higher is an advantage\nWe sell Spanish wine\nčeština a polština podmínkou"
    got = X.language_requirements(texts(spark, text, None, ""), "id", "t").collect()
    assert [(g.language, g.requirement, g.cefr, g.comparator) for g in got] == [("en", "required", None, None), ("de", "preferred", "B2", "at_least"), ("cs", "required", None, None), ("pl", "required", None, None)]
    assert {text[g.start : g.end] for g in got} == {"Fluent English required", " German B2 or higher is an advantage", "čeština a polština podmínkou"}


def test_pay(spark):
    text = "Salary 30 000 - 45 000 CZK / month gross in Brno\nBonus 500 EUR per year\n€60k annually\n90-80 EUR per day\n7 per hour"
    got = X.pay_offers(texts(spark, text, None), "id", "t", CITY_ALIASES).collect()
    assert [(int(g.low), g.high and int(g.high), g.currency, g.period, g.basis, g.component, g.places) for g in got] == [(30000, 45000, "CZK", "month", "gross", "base", "Brno"), (60000, None, "EUR", "year", "unknown", "unknown", None)]
    assert [text[g.start : g.end] for g in got] == ["30 000 - 45 000 CZK / month", "€60k annually"]
    long = "meal allowance 110 CZK per day\nsalary 5 EUR per day\n" + "word " * 90 + "pension 900 CZK monthly " + "more " * 90
    got = X.monetary_benefits(texts(spark, long), "id", "t").orderBy("start").collect()
    assert got[0].text == "meal allowance 110 CZK per day" and len(got) == 2
    assert got[1].text.startswith("word word") and "pension 900 CZK monthly" in got[1].text and len(got[1].text) < 260 and long[got[1].start : got[1].end].strip() == got[1].text


def test_titles_and_years_without_accents(spark):
    f = texts(spark, "Senior breditel reditel", "Manazerka", "lead generation (m/f/d)").select(X.title_facts(F.col("t")).alias("f")).select("f.*").collect()
    assert [(r.levels, r.leaders, r.role) for r in f] == [(["senior"], ["director"], "breditel reditel"), ([], ["manager"], "Manazerka"), ([], [], "lead generation")]
    got = X.experience_ranges(texts(spark, "2 az 5 let praxe\nMinimalne 3 roky, zkusenost"), "id", "t").collect()
    assert [(r.min_years, r.max_years, r.start) for r in got] == [(2, 5, 0), (3, None, 17)]


def test_verbs_need_a_qualifier(spark):
    m = X.dictionary_mentions(texts(spark, "you excel at work. skills: excel; React fast, and then some of us did react"), "id", "t", {"Excel": "excel", "React": "react"}, ("Excel", "React")).collect()
    assert sorted((r.value, r.start) for r in m) == [("Excel", 27), ("React", 34)]


def test_places(spark):
    got = one(spark, lambda c: PL.parse_place_label(c, COUNTRY_ALIASES, CITY_ALIASES), "Praha, Czechia", "Brno - Germany", "Remote", "", "Prague / Brno", "Hybrid in Brno 12", "all jobs", "a walk from Brno to Praha")
    assert [(g.city, g.country, g.reason) for g in got] == [("Prague", "CZ", None), (None, "DE", None), (None, None, "workplace_or_broad_scope"), (None, None, "empty"), (None, None, "unknown_label"), ("Brno", "CZ", None), (None, None, "navigation_or_marketplace"), (None, None, "unknown_label")]


def test_place_layouts(spark):
    labels = ("Office (Brno)", "Germany Prague", "Zlínský kraj", "Remote (Brno)", "Prague (Germany)", "Brno (Czechia)", "Remote in Praha, CZ", "Olomouc (hybrid)", None, "-", "Praha, hlavní město")
    got = one(spark, lambda c: PL.parse_place_label(c, COUNTRY_ALIASES, CITY_ALIASES, REGION_ALIASES), *labels)
    assert [(g.city, g.region, g.country) for g in got] == [(None, None, None), (None, None, "DE"), (None, "Zlínský kraj", "CZ"), ("Brno", None, "CZ"), (None, None, "DE"), ("Brno", None, "CZ"), ("Prague", None, "CZ"), ("Olomouc", None, "CZ"), (None, None, None), (None, None, None), ("Prague", None, "CZ")]
    city = lambda v, c: PL.typed_city(v, CITY_ALIASES, COUNTRY_ALIASES, REGION_ALIASES, c)
    rows = [("Brno, Czechia", "CZ"), ("Lhota (office)", "CZ"), ("Lhota (office)", None), ("Brno, Czechia", None), ("Lhota, Praha, Czechia", "CZ"), ("Praha 4", None), ("Lhota 4", "CZ"), ("Lhota 4", None), (None, "CZ"), ("", None)]
    assert one(spark, city, *rows, schema="a string, b string") == ["Brno", "Lhota", None, None, None, "Prague", "Lhota", None, None, None]


def test_item_scopes(spark):
    from tablewright.operators.html_text import item_records, read_items

    html = """<div itemscope itemtype="http://schema.org/JobPosting"><h1 itemprop="title name">Head <b>cook</b> &amp; baker<script>no</script></h1>
      <div itemprop="jobLocation" itemscope><span itemprop="name">Brno</span><br><meta itemprop="postalCode" content="60200"></div><a itemprop="url" href="https://x.example/1">more</a>
      <p itemprop="description">One <i itemprop="skills">two</i> three</div><span itemprop="title">outside</span></b>"""
    items, values = read_items(html)
    assert items == [(0, None, "http://schema.org/JobPosting", None), (1, 0, None, "jobLocation")]
    assert sorted(values) == sorted([(0, "title", "Head cook & baker"), (0, "name", "Head cook & baker"), (1, "name", "Brno"), (1, "postalCode", "60200"), (0, "url", "https://x.example/1"), (0, "skills", "two"), (0, "description", "One two three")])
    rows = item_records(spark.createDataFrame([(1, html), (2, None), (3, "<p itemscope>"), (4, "<p>")], "id int, h string"), "id", "h").collect()
    assert sorted((r.id, r.item) for r in rows) == [(1, 0)] * 5 + [(1, 1)] * 2 + [(3, 0)]


def test_dimensions_are_checked(spark, tmp_path):
    path = tmp_path / "iso.json"
    path.write_text(json.dumps({"3166-2": [{"code": "AA-01", "name": "North", "type": "State"}, {"code": "AA-NORTH", "name": "Nowhere", "type": "State"}, {"code": "BB-01", "name": "Sever", "type": "Region"}]}))
    rows = {(r.country, r.alias): r.name for r in load_dimension(spark, "subdivisions", str(path)).collect()}
    assert rows[("AA", "north")] == "North" and rows[("AA", "01")] == "North" and rows[("BB", "01")] == "Sever" and rows[("BB", "bb-01")] == "Sever"
    bad = spark.createDataFrame([("a", "x"), ("a", "y"), (" ", "z"), (None, "z")], "alias string, name string")
    assert sorted((r.key or "", r.problem) for r in check_dimension(bad, ("alias",)).collect()) == [("", "blank_key"), (" ", "blank_key"), ("a", "duplicate_key")]


def test_countries_of_the_iso_list(spark):
    rows = {r.alias: r.country for r in load_dimension(spark, "countries").collect()}
    assert rows["nzl"] == rows["new zealand"] == "NZ" and rows["cesko"] == "CZ" and len(set(rows.values())) > 240


def test_unknown_activity_counts_as_active(spark):
    c = spark.createDataFrame([("a", "x", 5, None, "1"), ("a", "y", 5, False, "2"), ("b", "x", 5, None, "3"), ("b", "y", 5, True, "4")], "k string, value string, score int, active boolean, evidence_id string")
    assert {r.k: (r.state, r.value) for r in P.select_fact(c, ["k"]).collect()} == {"a": ("known", "x"), "b": ("conflict", None)}
    d = spark.createDataFrame([("j", "complete", None, 1, 10, "s", 1), ("j", "complete", False, 2, 90, "s", 2)], "job string, quality string, active boolean, native int, length int, source string, id int")
    assert [r.id for r in P.select_description(d, "job").where("selected").collect()] == [1]


def test_modes_of_feeds(spark):
    rule = lambda feed: lambda c: V.remote_type(c, feed)
    assert one(spark, rule("smartrecruiters_direct"), "true", "false", None) == ["remote", "unknown", "unknown"]
    assert one(spark, rule("ashby_direct"), "OnSite", "true", "temporary") == ["onsite", "remote", "unknown"]
    assert one(spark, rule("workday_direct"), "Partially Remote", "In person", "on site only") == ["hybrid", "onsite", "unknown"]
    body = lambda **k: json.dumps(k)
    rows = lambda *b: spark.createDataFrame([("s", x) for x in b], "scope string, body string")
    mode = lambda feed, *b: [r.remote_type for r in S.project_canonical(rows(*b), feed).collect()]
    assert mode("smartrecruiters_direct", body(location={"remote": True}), body(location={"remote": False})) == ["remote", "unknown"]
    assert mode("ashby_direct", body(workplaceType="x", isRemote=True), body(workplaceType="Hybrid", isRemote=True)) == ["remote", "hybrid"]
    assert mode("fantastic_jobs_apify", body(location_type="TELECOMMUTE", ai_work_arrangement="On-site"), body(ai_work_arrangement="On-site")) == ["remote", "onsite"]


def test_contained_texts_of_few_words(spark):
    word, five = "x1" * 65, " ".join(c * 300 for c in "abcde")
    small = spark.createDataFrame([(1, word), (2, five), (3, "a" + " " * 130 + "b"), (4, "z" * 130)], "s int, text string")
    big = spark.createDataFrame([(1, f"see y{word}y here"), (2, f"start a{five}e end"), (3, "ba" + " " * 130 + "bb"), (4, "nothing of it " * 20)], "b int, text string")
    assert {(r.s, r.b) for r in L.contained_in(small, "s", big, "b").collect()} == {(1, 1), (2, 2), (3, 3)}


def test_duplicates_with_word_similarity(spark):
    desc = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, "acme", "data analyst", "brno", False, desc), (2, "acme", "data analyst", "brno", False, desc), (3, "acme", "data analyst", "brno", False, desc), (4, "acme", "data analyst ii", "brno", False, "jumps over the lazy dog"), (5, "other", "data analyst", "brno", False, desc), (6, "", "data analyst", "brno", False, desc)]
    jobs = spark.createDataFrame(rows, "id int, block string, title string, location string, remote boolean, description string")
    sources = spark.createDataFrame([(i, "lever_direct" if i != 5 else "odd") for i in range(1, 7)], "job_id int, source_name string")
    got = {(r.a, r.b): r for r in L.duplicate_candidates(jobs, None, sources, ["lever_direct"]).collect()}
    assert got.keys() == {(1, 2), (1, 3), (1, 4)} and got[1, 2].confidence == 1.0 and got[1, 4].description_similarity == pytest.approx(best_extent("jumps over the lazy dog", desc))
    old = spark.createDataFrame([(1, 2, "rejected"), (1, 4, "pending")], "a int, b int, status string")
    again = L.rebuilt_candidates(old, L.duplicate_candidates(jobs, old, words=False).select("a", "b", "confidence"))
    assert {(r.a, r.b): r.status for r in again.collect()} == {(1, 2): "rejected", (1, 3): "pending", (1, 4): "pending"}


def test_word_similarity_equals_all_extents(spark):
    rng = random.Random(3)
    pairs = [tuple(" ".join(rng.choices(["data", "analyst", "date", "ana", "baker", "x", "Ünï"], k=rng.randrange(0, n))) for n in (4, 9)) for _ in range(200)]
    assert one(spark, word_similarity, *pairs, schema="a string, b string") == pytest.approx([best_extent(a, b) for a, b in pairs])


def test_word_similarity_of_long_texts(spark):
    """The runs of long texts are all looked at, but not one by one: 28 pairs of 7,000 trigrams in seconds."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 7))) for _ in range(400)]
    short = [(f"s{i}", " ".join(rng.choices(words[: rng.randrange(5, 60)], k=rng.randrange(1, 40)))) for i in range(40)]
    texts = dict([*short, *((f"l{i}", " ".join(rng.choices(words[i * 20 :], k=1500))) for i in range(8)), ("n", ""), ("m", "!!")])
    pairs = [(a, b) for a in texts for b in texts if a < b and (a[0] == b[0] or "n" in (a, b) or "m" in (a, b))]
    start = time.monotonic()
    scores = L.text_scores(spark.createDataFrame(pairs, "ha string, hb string"), spark.createDataFrame(list(texts.items()), "h string, t string"), words=True, within=120)
    got = {(r.ha, r.hb): r for r in scores.collect()}
    assert time.monotonic() - start < 60 and len(got) == len(pairs)

    def expected(a, b):
        if not a or not b:
            return 0.0
        x, y = set(ordered_trigrams(a)), set(ordered_trigrams(b))
        return max(best_extent(*sorted((a, b), key=len)), len(x & y) / max(1, len(x | y)))

    for a, b in pairs:
        if "l" not in (a[0], b[0]):
            assert got[a, b].text_similarity == pytest.approx(expected(texts[a], texts[b])), (a, b)


def test_similar_pairs_of_large_blocks_meet_once(spark, monkeypatch):
    monkeypatch.setattr(L, "SMALL_BLOCK", 3)
    rng = random.Random(11)
    words = ["data", "date", "analyst", "analysis", "baker", "bakery", "senior", "ii", "x"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(120)]
    df = spark.createDataFrame([(i, f"b{i % 2}", t) for i, t in enumerate(texts)], "id int, block string, t string")
    for least in (0.45, 0.98):
        got = L.similar_pairs(df, "block", "id", "t", least).collect()
        sets = [set(ordered_trigrams(t)) for t in texts]
        every = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(120) for b in range(a + 1, 120) if a % 2 == b % 2}
        assert {(r.a, r.b): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in every.items() if v >= least} and len({(r.a, r.b) for r in got}) == len(got)


def long_texts(rng, n, words):
    known = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=rng.randrange(2, 9))) for _ in range(2000)]
    return [" ".join(rng.choices(known, k=words)) for _ in range(n)]


@pytest.mark.parametrize("words", [False, True])
def test_texts_go_to_tiles_not_to_pairs(spark, monkeypatch, words):
    """All pairs of 50 long texts: the texts are shuffled a few times each, not once for each pair."""
    rows = [(f"h{i:02d}", t) for i, t in enumerate(long_texts(random.Random(2), 50, 700))]
    texts = spark.createDataFrame(rows, "h string, t string")
    pairs = spark.createDataFrame([(a, b) for a, _ in rows for b, _ in rows if a < b], "ha string, hb string")
    monkeypatch.setattr(storage, "_FREED", "spark.sql.adaptive.enabled", raising=False)  # shuffle files stay, to be counted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def files() -> int:
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(f.length() for f in (found.apply(i) for i in range(found.size())) if "shuffle_" in f.getName())

    try:
        before = files()
        assert L.text_scores(pairs, texts, words, 120).count() == 1225
        assert files() - before < 4e6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scores_are_the_same_in_any_tiles_and_rounds(spark, monkeypatch):
    rng = random.Random(4)
    some = ["", "!!", "a", "Ünï código, 12", "two  words", " lead", "trail ", " ", "   "]
    long = long_texts(rng, 6, 60)
    texts = [*some, *long, *(t[5:-7] for t in long), *(f"Kopf: {t}\nEnde" for t in long[:3])]
    pairs = [(f"h{i}", f"h{j}") for i in range(len(texts)) for j in range(i, len(texts))]
    given = (spark.createDataFrame(pairs * 2, "ha string, hb string"), spark.createDataFrame([(f"h{i}", t) for i, t in enumerate(texts)] * 2, "h string, t string"))
    plain = lambda: sorted(tuple(r) for r in L.text_scores(*given, words=False, within=20).collect())
    usual = plain()
    want = {}
    for a, b in pairs:
        x, y = texts[int(a[1:])], texts[int(b[1:])]
        g, k = set(ordered_trigrams(x)), set(ordered_trigrams(y))
        want[a, b] = (0.0 if not x or not y else 1.0 if x == y else len(g & k) / max(1, len(g | k)), (len(x) >= 20 and x in y) or (len(y) >= 20 and y in x))
    assert {(a, b): (s, c) for a, b, s, c in usual} == want and len(usual) == len(pairs) and sum(c for *_, c in usual) > 20
    monkeypatch.setattr(L, "TILE_TEXTS", 2)
    monkeypatch.setattr(L, "ROUND_CHARS", 20_000)
    assert plain() == usual


def test_candidates_leave_nothing_else_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch", lambda spark, name: str(tmp_path / f"{name}-{uuid.uuid4().hex}"))
    jobs = spark.createDataFrame([(i, "acme", "data analyst" + " ii" * (i % 2), "brno", False, "text " * i) for i in range(6)], "id int, block string, title string, location string, remote boolean, description string")
    assert L.duplicate_candidates(jobs).count() == 15
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["candidates"]


def test_best_run_is_that_of_all_runs():
    rng = random.Random(7)
    for n in (0, 1, 5, 40, 300):
        for kinds in (3, 20, 200):
            row, wanted = np.array([rng.randrange(kinds) for _ in range(n)], np.int32), np.unique([rng.randrange(kinds) for _ in range(kinds // 2)]).astype(np.int32)
            want, best = set(wanted.tolist()), 0.1
            for i in range(n):
                seen = set()
                for g in row[i:].tolist():
                    seen.add(g)
                    best = max(best, len(seen & want) / len(seen | want))
            assert best_run(wanted, row, 0.1) == best


def test_vacancy_statements_in_long_sentences(spark):
    long = "word " * 20_000
    texts = {
        long + "there is no suitable vacancy, " + long + "nothing more": None,
        long + "there is no suitable vacancy today. \n Send us your CV": "talent_pool",
        "no current openings but send us your resume": "talent_pool",
        "no current openings \n\n please send us your cv": "talent_pool",
        "no current openings. One. Send us your cv": None,
        "no current openings \n please \n send us your cv": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    start = time.monotonic()
    assert [r.k for r in df.select(X.opportunity_type(F.lit("Baker"), F.col("t")).alias("k")).collect()] == list(texts.values())
    assert time.monotonic() - start < 30


@pytest.mark.parametrize("name", ["x08_pay_offers", "x11_opportunity_type", "s06_p01_lever_direct"])
def test_rows_of_one_file_are_many_tasks(spark, sf_dir, name):
    from tablewright import registry

    assert registry.queries()[name](spark, sf_dir).rdd.getNumPartitions() >= 4


def test_page_items_sql_resolves_what_the_parser_does(spark, tmp_path):
    import duckdb

    from tablewright import registry

    titles = ["a &amp;&amp b&amp", "t = &quot;x&quot", "&lt;b&gt &#39;c&#x27;", "&amp;quot; &amp;amp;", "cut &am", "it &amp; is"]
    rows = [(i, "https://a.example/x", f"<html><title>{t}</title></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    stated = con.sql(f"SELECT page_id, title FROM ({registry.oracle_sql()['s08_page_items']}) ORDER BY 1").fetchall()
    got = registry.queries()["s08_page_items"](spark, str(tmp_path)).select("page_id", "title").orderBy("page_id").collect()
    assert stated == [tuple(r) for r in got] and stated[0][1] == "a && b&"


def test_neighbour_context(spark):
    docs = texts(spark, "a one b one c", "one")
    got = X.neighbour_context(X.find_all(docs, "id", "t", "one"), ["id"], docs, "id", "t").collect()
    assert sorted((r.id, r.start, r.before, r.after) for r in got) == [(0, 2, "a ", " b "), (0, 8, " b ", " c"), (1, 0, "", "")]


def test_policies_are_checked(spark):
    t = lambda d: dt.datetime(2026, 1, d)
    rows = [("a", "known_gap", t(1), t(5)), ("b", "odd", t(1), t(5)), ("c", "known_gap", t(5), t(1)), ("a", "known_gap", t(1), t(5))]
    bad = check_policies(spark.createDataFrame(rows, "scope string, state string, reviewed_at timestamp, review_expires_at timestamp"), ("known_gap",), ["scope"])
    assert {(r.scope, r.problem) for r in bad.collect()} == {("a", "duplicate_key"), ("b", "unknown_state"), ("c", "dates_out_of_order")}


def test_empty_frames(spark):
    none = spark.createDataFrame([], "scope string, source_name string, ok boolean, started_at timestamp, id int, error string")
    assert H.failure_streak(none, "scope").count() == 0 and H.latest_runs(none).count() == 0


def test_landing_and_ingest_stream(spark, tmp_path):
    rec = lambda i, v, day: json.dumps({"source_name": "lever_direct", "scope": "acme", "run_id": "r", "page_no": 1, "fetched_at": f"2026-01-0{day}T00:00:00", "body": json.dumps({"id": i, "text": v})})
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text("\n".join([rec("1", "Baker", 1), rec("2", "Cook", 1), "not json"]))
    rows = S.read_landing(spark, str(land))
    assert rows.where("body IS NOT NULL").count() == 2
    assert {r.title for r in S.project_canonical(rows.where("body IS NOT NULL"), "lever_direct").collect()} == {"Baker", "Cook"}
    args = (str(land), str(tmp_path / "store"), str(tmp_path / "cp"))
    streams.start_ingest_stream(spark, *args).awaitTermination()
    (land / "b.json").write_text("\n".join([rec("1", "Baker", 2), rec("2", "Chef", 2)]))
    streams.start_ingest_stream(spark, *args).awaitTermination()
    streams.start_ingest_stream(spark, *args).awaitTermination()
    got = sorted(json.loads(r.body)["text"] for r in spark.read.parquet(args[1]).collect())
    assert got == ["Baker", "Chef", "Cook"]


def test_times_alone_change_no_job(spark):
    cols = "source_name string, source_job_id string, job_id int, source_url string, is_active boolean, payload_hash string"
    old = spark.createDataFrame([("s", "1", 1, "u", True, "h"), ("s", "2", 2, "u", True, "h"), ("s", "3", 3, "u", None, "h")], cols)
    new = spark.createDataFrame([("s", "1", 1, "u", True, "h"), ("s", "2", 9, "u", True, "h"), ("s", "3", 3, "u", None, "h")], cols)
    assert {r.job_id for r in streams.changed_jobs(old, new).collect()} == {2, 9}


def test_neighbour_context_on_the_table(spark, sf_dir):
    """The query of W10 against plain string work on every document."""
    import re

    from tablewright.plans.profiling import w10

    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        spans = [m.span() for m in re.finditer(r"(?i)(?<!\w)that(?!\w)", r.text or "")]
        edges = [0, *[b for _, b in spans]], [*[a for a, _ in spans], len(r.text or "")]
        want += [(r.doc_id, a, a - edges[0][k], edges[1][k + 1] - b) for k, (a, b) in enumerate(spans)]
    assert sorted(tuple(r) for r in w10(spark, sf_dir).collect()) == sorted(want) and len(want) > 100


def test_clean_html_on_the_table(spark, sf_dir):
    """The query of X01 against a parser that walks the tree, on every page."""
    import html
    import re
    from html.parser import HTMLParser

    from tablewright.plans.profiling import x01

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.waiting, self.depth = [], None, 0

        def handle_starttag(self, tag, attrs):
            alone = tag in HT.ENDLESS
            if self.depth:
                self.depth += tag == self.waiting and not alone
                return
            given = {k: v or "" for k, v in attrs}
            hidden = tag in HT.UNSEEN or "hidden" in given or given.get("aria-hidden") == "true" or any(HT.CONTAINERS.search(given.get(k, "")) for k in ("class", "id", "role"))
            if hidden and not alone:
                self.waiting, self.depth = tag, 1
            elif not hidden:
                self.out.append(HT.STARTS.get(tag, ""))

        def handle_endtag(self, tag):
            if self.depth:
                self.depth -= tag == self.waiting
            elif tag in HT.ENDS:
                self.out.append("\n")

        def handle_data(self, data):
            if not self.depth:
                self.out.append(html.unescape(data))

    def plain(raw):
        for _ in range(3):
            raw = html.unescape(raw)
        walk = Walk()
        walk.feed(raw)
        walk.close()
        return "\n".join(filter(None, (" ".join(x.split()) for x in re.split(r"\r\n?|\n", "".join(walk.out)))))

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in x01(spark, sf_dir).collect()}
    assert got == {k: plain(v) for k, v in pages.items()}
