"""Facts out of text: matches with spans, sections, quality, opportunity types and places.

Matches come as one row each (doc_id, field, value, start, end, text); spans count characters from 0, end excluded, in the cleaned text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.text import fold, fold_spaces, let
from tablewright.functions.values import MINOR_UNITS, mapped


SPANS = "array<struct<start:int,end:int,text:string>>"


def placed(gaps: Column, hits: Column) -> Column:
    """Spans of `hits`, one behind each of `gaps`: the lengths before a hit give its start, so no row leaves its text."""

    def step(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.length(z["gap"])
        end = start + F.length(z["hit"])
        return F.struct(F.coalesce(end, start).alias("at"), F.when(end.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), z["hit"].alias("text")))).alias("out"))

    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out")), step, lambda acc: acc["out"])


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern in order, as spans: what splitting leaves lies between them."""
    return placed(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def lines(text: Column) -> Column:
    """All lines, as spans."""
    every = F.split(text, "\n", -1)
    return placed(F.transform(every, lambda _, k: F.when(k == 0, F.lit("")).otherwise(F.lit("\n"))), every)


def whole_word(pattern: str) -> str:
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{pattern})(?![\p{{L}}\p{{N}}_])"


def named_matches(text: Column, pattern: str, name: str) -> Column:
    """Matches with a name: (value, start, end, text)."""
    return F.transform(matches(text, pattern), lambda m: F.struct(F.lit(name).alias("value"), m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text")))


def find_all(docs: DataFrame, id_col: str, text: str, pattern: str, group: int = 0) -> DataFrame:
    """(id, k, text, start, end) of all matches of a pattern, and the value of a group."""
    each = docs.select(F.col(id_col), F.posexplode(matches(F.col(text), pattern)).alias("k", "m"))
    out = each.select(id_col, "k", F.col("m.text").alias("text"), F.col("m.start").alias("start"), F.col("m.end").alias("end"))
    return out if group == 0 else out.withColumn("value", F.regexp_extract("text", pattern, group))


def dictionary_mentions(docs: DataFrame, id_col: str, text: str, dictionary: dict[str, str], verbs: tuple[str, ...] = (), qualifier: str = r"(?i)microsoft|react native|skills|proficien|experience with|knowledge of|using|\btools?\b") -> DataFrame:
    """Mentions of each term's pattern on word borders, any case, in one pass over the texts. A term of `verbs` that is written all
    in small letters counts only with a qualifier in the 40 characters before it or the 15 behind it."""
    found = F.concat(*[named_matches(F.col(text), whole_word(p), term) for term, p in dictionary.items()])
    if verbs:
        near = lambda m: F.substring(F.col(text), F.greatest(m["start"] - 39, F.lit(1)), m["end"] - F.greatest(m["start"] - 40, F.lit(0)) + 15)
        found = F.filter(found, lambda m: ~m["value"].isin(*verbs) | (m["text"] != F.lower(m["value"])) | near(m).rlike(qualifier))
    return docs.select(F.col(id_col), F.inline(found))


#: What a cut-off text ends with, and what stands in for a text.
CUT_OFF = r"(?i)(?:read more|show more|zobrazit vice|zobrazit více|\.\.\.|…)\s*$"
SHELL = r"(?i)^(?:apply now|job not found|this job is no longer available|sign in|register)[.!\s]*$"


def description_quality(text: Column, source: Column, snippet_sources: tuple[str, ...] = ("jooble_direct",)) -> Column:
    """Empty, snippet, template, short or complete, in that order."""
    text = F.coalesce(text, F.lit(""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return (
        F.when(text == "", "empty").when(text.rlike(CUT_OFF), "snippet").when(source.isin(*snippet_sources), "snippet").when(text.rlike(SHELL), "template").when((F.length(text) < 500) | (words < 60), "short").otherwise("complete")
    )


#: Level and leadership words of titles.
LEVELS = {"junior": r"\b(?:junior|jr)\b\.?", "senior": r"\b(?:senior|sr)\b\.?", "staff": r"\bstaff\b", "principal": r"\bprincipal\b"}
LEADERS = {"lead": r"\blead\b(?!\s+generation)", "head": r"\bhead\b", "director": r"\bdirector\b|\bředitel\w*|\breditel\w*", "manager": r"\bmanager\b|\bmanažer\w*|\bmanazer\w*", "vedouci": r"\bvedouc[íi]\b"}
#: Marks of a title that are no part of the role, before and behind it.
TITLE_MARKS = (r"(?i)^(?:senior|sr\.?|junior|jr\.?)\s+", r"(?i)\s*\((?:m/f/d|f/m/d|m/f|w/m/d)\)\s*$")


def title_facts(title: Column, levels: dict[str, str] = LEVELS, leaders: dict[str, str] = LEADERS, marks: tuple[str, ...] = TITLE_MARKS) -> Column:
    """The role without its marks, and the names of the level and leadership patterns that the title meets."""
    role = title
    for mark in marks:
        role = F.regexp_replace(role, mark, "")

    def names(patterns: dict[str, str]) -> Column:
        tested = F.array(*[F.struct(F.lit(name).alias("name"), title.rlike("(?iU)" + p).alias("met")) for name, p in patterns.items()])
        return F.transform(F.filter(tested, lambda t: t["met"]), lambda t: t["name"])

    return F.struct(names(levels).alias("levels"), names(leaders).alias("leaders"), F.nullif(F.trim(role), F.lit("")).alias("role"))


def lines_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, k, line, start, end) of each line."""
    each = docs.select(F.col(id_col), F.posexplode(lines(F.col(text))).alias("k", "m"))
    return each.select(id_col, "k", F.col("m.text").alias("line"), F.col("m.start").alias("start"), F.col("m.end").alias("end"))


def section_spans(docs: DataFrame, id_col: str, text: str, headings: dict[str, str]) -> DataFrame:
    """X07 with W09: a line that is a heading opens a section; it ends where the next heading starts. `headings`: folded label to kind."""
    kinds = F.create_map(*[F.lit(x) for kv in headings.items() for x in kv])
    label = lambda line: F.trim(F.regexp_replace(fold(line), r"^[#:\s]+|[#:\s]+$", ""))
    marked = F.transform(lines(F.col(text)), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.element_at(kinds, label(m["text"])).alias("kind")))
    docs = docs.select(F.col(id_col), F.col(text).alias("_t"), F.filter(marked, lambda m: m["kind"].isNotNull()).alias("_h")).where(F.size("_h") > 0)
    each = docs.select(id_col, "_t", "_h", F.posexplode("_h").alias("_k", "_m")).withColumn("_stop", F.coalesce(F.get("_h", F.col("_k") + 1)["start"], F.length("_t")))
    body = F.trim(F.col("_t").substr(F.col("_m.end") + 1, F.col("_stop") - F.col("_m.end")), F.lit(" \n\t\r"))
    return each.select(id_col, F.col("_m.kind").alias("kind"), F.col("_m.start").alias("start"), F.col("_stop").alias("end"), body.alias("content")).where("content <> ''")


def neighbour_context(matches: DataFrame, by: list[str], docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The text between a match and its neighbours in the same group."""
    w = Window.partitionBy(*by).orderBy("start")
    m = matches.withColumns({"_from": F.coalesce(F.lag("end").over(w), F.lit(0)), "_to": F.lead("start").over(w)})
    j = m.join(docs.select(F.col(id_col), F.col(text).alias("_t")), id_col)
    cut = lambda a, b: F.col("_t").substr(a + 1, b - a)
    return j.withColumns({"before": cut(F.col("_from"), F.col("start")), "after": cut(F.col("end"), F.coalesce("_to", F.length("_t")))}).drop("_from", "_to", "_t")


#: Number words and what an experience clause looks like.
NUMBER_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10}
EXPERIENCE = r"(?iu)(?<![\p{L}\p{N}_])(?:(?:at least|minimum(?: of)?|min\.?|alespoň|alespon|minimálně|minimalne)\s+)?(\d{1,2}|one|two|three|four|five|six|seven|eight|nine|ten)\s*(?:\+|(?:[-–—]|to|až|az)\s*(\d{1,2}))?\s*(?:years?|let|roky|roků|roku)(?![\p{L}\p{N}_])"


def experience_ranges(docs: DataFrame, id_col: str, text: str, pattern: str = EXPERIENCE, context: str = r"(?iu)experience|praxe|zkušenost|zkusenost", reject: str = r"(?i)founded|anniversary|company history|revenue|contract duration|our company|we have|we bring") -> DataFrame:
    """Years asked for, within a line that speaks of experience and not of the company; at most 60 and in order."""
    on_lines = docs.select(F.col(id_col), F.inline(lines(F.col(text)))).where(F.col("text").rlike(pattern))
    m = on_lines.select(id_col, F.col("start").alias("_at"), F.col("text").alias("line"), F.inline(matches(F.col("text"), pattern)))
    word = F.lower(F.regexp_extract("text", pattern, 1))
    number = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in kv]), word), word.try_cast("int"))
    high = F.nullif(F.regexp_extract("text", pattern, 2), F.lit("")).cast("int")
    near = F.col("line").substr(F.greatest(F.col("start") - 54, F.lit(1)), F.col("end") - F.greatest(F.col("start") - 55, F.lit(0)) + 70)
    good = (near.rlike(context) | (F.trim("line") == F.trim("text"))) & ~near.rlike(reject)
    out = m.where(good).select(id_col, number.alias("min_years"), high.alias("max_years"), (F.col("_at") + F.col("start")).alias("start"), (F.col("_at") + F.col("end")).alias("end"), "text")
    return out.where("min_years <= 60 AND (max_years IS NULL OR (max_years <= 60 AND max_years >= min_years))")


#: Languages by their names, the words that make a clause a requirement, and levels.
LANGUAGES = {"en": r"english|angličtin\w*|anglictin\w*", "cs": r"czech(?!\s+republic)|češtin\w*|cestin\w*", "de": r"german|němčin\w*|nemcin\w*", "fr": r"french|francouzštin\w*", "es": r"spanish|španělštin\w*", "pl": r"polish|polštin\w*"}
LANGUAGE_CONTEXT = r"(?iu)fluent|fluency|proficien|advanced|professional|speaking|spoken|written|native|\b[A-C][12]\+?\b|\brequired\b|\bpreferred\b|essential|advantage|plynul|znalost|úrov|urov|výhod|vyhod|podmín|podmin"
QUALIFIER = r"(?iu)required|preferred|essential|advantage|výhod|vyhod|podmín|podmin"
REQUIRED, PREFERRED = r"(?iu)required|essential|must|podmín|podmin|nutn", r"(?iu)preferred|advantage|a plus|výhod|vyhod"
CEFR = r"(?i)(?<!\w)([ABC][12])(?!\w)(\+|\s+(?:level\s+)?or\s+(?:above|higher))?"
AT_LEAST, EXACTLY = r"(?iu)(?:minimum(?: of)?|at least|min\.?|minimálně|alespoň)\s*$", r"(?i)exactly\s*$"
#: Characters behind a language, before it, and before it for a level, that can qualify it.
BEHIND, BEFORE, BEFORE_LEVEL = 65, 40, 30


def between(text: Column, start: Column, end: Column) -> Column:
    return text.substr(start + 1, end - start)


def language_requirements(docs: DataFrame, id_col: str, text: str, languages: dict[str, str] = LANGUAGES) -> DataFrame:
    """(language, requirement, cefr, comparator, start, end) of each language that a clause asks for; start and end are the clause's.
    Clauses end at line breaks, semicolons and commas. A language takes the qualifier behind it; without one it shares that of a
    coordinated list (`and`), or else takes the one before it. Its level stands behind it, or before the first language."""
    clauses = docs.select(F.col(id_col), F.inline(matches(F.col(text), r"[^\n;,]+"))).where(F.col("text").rlike(LANGUAGE_CONTEXT))
    named = F.concat(*[named_matches(F.col("text"), whole_word(p).replace("(?iu)", "(?iU)"), code) for code, p in languages.items()])
    each = clauses.withColumn("_all", F.array_sort(F.transform(named, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("code"))))).where(F.size("_all") > 0).select(id_col, "start", "end", "text", "_all", F.posexplode("_all").alias("_k", "_m"))
    clause = F.col("text")
    before = between(clause, F.coalesce(F.get("_all", F.col("_k") - 1)["end"], F.lit(0)), F.col("_m.start"))
    behind = F.left(between(clause, F.col("_m.end"), F.coalesce(F.get("_all", F.col("_k") + 1)["start"], F.length(clause))), F.lit(BEHIND))
    each = each.withColumns({"_before": before, "_behind": behind})
    listed = (F.size("_all") > 1) & clause.rlike(r"(?i)\band\b|\ba\b")
    each = each.withColumn("_said", F.when(F.col("_behind").rlike(QUALIFIER), F.col("_behind")).when(listed, clause).otherwise(F.right("_before", F.lit(BEFORE))))
    near = F.when(F.col("_behind").rlike(CEFR), F.col("_behind")).when(F.col("_k") == 0, F.right("_before", F.lit(BEFORE_LEVEL)))
    each = each.withColumn("_near", F.coalesce(near, F.lit("")))
    need, like = F.col("_said").rlike(REQUIRED), F.col("_said").rlike(PREFERRED)
    level = F.nullif(F.upper(F.regexp_extract("_near", CEFR, 1)), F.lit(""))
    lead = F.get(F.split("_near", CEFR, 2), F.lit(0))
    low = (F.regexp_extract("_near", CEFR, 2) != "") | lead.rlike(AT_LEAST)
    return each.select(
        id_col,
        F.col("_m.code").alias("language"),
        F.when(need & ~like, "required").when(like & ~need, "preferred").otherwise("unknown").alias("requirement"),
        level.alias("cefr"),
        F.when(level.isNull(), F.lit(None).cast("string")).when(low, "at_least").when(lead.rlike(EXACTLY), "exact").otherwise("unknown").alias("comparator"),
        "start",
        "end",
    )


#: The parts of a pay mention, lines that speak of other money, lines that name a benefit, and words for the base pay.
PAY_NUMBER = r"\d+(?:[ ,\u00a0]\d{3})*(?:\.\d{1,2})?\s*k?"
PAY_CURRENCIES = ("CZK", "Kč", "EUR", "USD", "GBP")
PAY_UNITS = {"month": "month", "year": "year", "hour": "hour", "day": "day"}
PAY_ADVERBS = {"monthly": "month", "annually": "year", "annual": "year", "yearly": "year", "hourly": "hour", "měsíčně": "month", "mesicne": "month", "ročně": "year", "rocne": "year", "hodinu": "hour"}
OTHER_MONEY = r"(?iu)bonus|referr|reward|voucher|revenue|budget|meal|benefit|sign.on|signing|stipend|cafeteria|multisport|pension|retirement contribution|wellness allowance|commuting allowance|travel allowance|příspěv|prispev|straven|obrat|odměn|odmen"
BENEFIT = r"(?iu)pension|retirement contribution|meal allowance|wellness allowance|commuting allowance|referr|voucher|příspěv|prispev|straven"
BASE_PAY, GROSS, NET = r"(?iu)salary|base pay|mzda|plat\b", r"(?i)gross|hrub", r"(?iu)\bnet\b|čist|cist"
#: Characters of a line that is quoted whole; of a longer one so many before and behind the sum.
LONG_LINE, AHEAD, AFTER = 400, 140, 80


def pay_pattern() -> str:
    """Groups: euro sign, low, high, currency, unit, adverb."""
    units, adverbs = "|".join(PAY_UNITS), "|".join(PAY_ADVERBS)
    period = rf"(?:(?:/|per\s+)\s*({units})|({adverbs}))"
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(€\s*)?({PAY_NUMBER})(?:\s*[-–—]\s*({PAY_NUMBER}))?\s*({'|'.join(PAY_CURRENCIES)})?\s*{period}(?![\p{{L}}\p{{N}}_])"


def money_on_lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, line, line_start, start, end, text, currency) of each sum for a time, by line; only lines with a digit are searched."""
    pattern = pay_pattern()
    on = docs.select(F.col(id_col), F.inline(lines(F.col(text)))).where(F.col("text").rlike(r"\d"))
    each = on.select(id_col, F.col("text").alias("line"), F.col("start").alias("line_start"), F.inline(matches(F.col("text"), pattern)))
    part = F.nullif(F.regexp_extract("text", pattern, 4), F.lit(""))
    currency = F.when(F.regexp_extract("text", pattern, 1) != "", "EUR").when(F.lower(part) == "kč", "CZK").otherwise(F.upper(part))
    return each.withColumn("currency", currency).where("currency IS NOT NULL")


def pay_offers(docs: DataFrame, id_col: str, text: str, cities: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(low, high, currency, period, basis, component, places, start, end) of each pay offer. Lines that speak of other money are none; an offer
    holds for the cities that its line names (null: none named)."""
    from tablewright.functions.values import amount, mapped

    pattern = pay_pattern()
    m = money_on_lines(docs, id_col, text).where(~F.col("line").rlike(OTHER_MONEY))
    group = lambda k: F.nullif(F.regexp_extract("text", pattern, k), F.lit(""))
    of = lambda line: F.array_compact(F.array(*[F.when(line.rlike(whole_word(alias)), F.lit(city)) for alias, (city, _) in (cities or {}).items()])).cast("array<string>")
    named = let(fold(F.col("line")), of)
    out = m.select(
        id_col,
        amount(group(2)).alias("low"),
        amount(group(3)).alias("high"),
        group(3).isNotNull().alias("_range"),
        "currency",
        mapped(F.lower(F.coalesce(group(5), group(6))), PAY_UNITS | PAY_ADVERBS).alias("period"),
        F.when(F.col("line").rlike(GROSS), "gross").when(F.col("line").rlike(NET), "net").otherwise("unknown").alias("basis"),
        F.when(F.col("line").rlike(BASE_PAY), "base").otherwise("unknown").alias("component"),
        F.nullif(F.array_join(F.array_distinct(named), "|"), F.lit("")).alias("places"),
        (F.col("line_start") + F.col("start")).alias("start"),
        (F.col("line_start") + F.col("end")).alias("end"),
    )
    return out.where("low IS NOT NULL AND (NOT _range OR high >= low)").drop("_range")


def monetary_benefits(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(text, start, end) of each line that states a benefit's sum. Of a long line a window around the sum is quoted, from a word's start."""
    m = money_on_lines(docs, id_col, text)
    size = F.length("line")
    long = size > LONG_LINE
    start = F.when(long, F.greatest(F.lit(0), F.col("start") - AHEAD)).otherwise(F.lit(0))
    end = F.when(long, F.least(size, F.col("end") + AFTER)).otherwise(size)
    m = m.withColumns({"_from": start, "_to": end})
    ahead = between(F.col("line"), F.col("_from"), F.col("start"))
    inside = (F.col("_from") > 0) & ~F.col("line").substr(F.col("_from"), F.lit(1)).rlike(r"\s")
    gap = F.instr(ahead, " ")
    m = m.withColumn("_from", F.col("_from") + F.when(inside, gap).otherwise(F.lit(0)))
    quoted = between(F.col("line"), F.col("_from"), F.col("_to"))
    out = m.where(quoted.rlike(BENEFIT)).select(id_col, F.trim(quoted).alias("text"), (F.col("line_start") + F.col("_from")).alias("start"), (F.col("line_start") + F.col("_to")).alias("end"))
    return out.dropDuplicates([id_col, "start", "end"])


def arrangement_clauses(docs: DataFrame, id_col: str, text: str, rules: list[tuple[str, str]]) -> DataFrame:
    """The first rule that a line meets, with the line."""
    from tablewright.functions.values import first_match

    return lines_of(docs, id_col, text).withColumn("value", first_match(F.col("line"), rules)).where("value IS NOT NULL").select(id_col, "value", "start", "end", F.col("line").alias("text"))


#: Titles that are no ordinary vacancy, and people who run such things.
OPPORTUNITIES = [("talent_pool", r"\b(?:talent pool|talent community|open application|spontaneous application)\b"), ("hackathon", r"\bhackathon\b(?:\s+\d{4}\b)|^hackathon$"), ("event", r"\b(?:career fair|recruiting event|recruitment event|hiring event)\b"), ("internship_program", r"\b(?:internship|graduate|trainee) program(?:me)?\b")]
ORGANIZER = r"(?i)\b(?:manager|organizer|coordinator|director|engineer|developer|head|lead|producer|specialist)\b"
#: What stands between the two statements is on one line, or has one end of a sentence or line in it; taken in that order, nothing is tried twice.
NO_VACANCY = r"(?iu)(?:nemáme zrovna volnou pozici|no (?:current|suitable|matching) (?:vacanc(?:y|ies)|openings?))(?:[^\n.!?]*?|[^\n.!?]*+[\n.!?]\s*+[^\n.!?]*?)(?:pošlete nám svůj životopis|send us your (?:cv|resume))"
HIRING = r"(?iu)(?:^|\n)[^\n]*(?:we are (?:hiring|seeking|looking for) (?:a|an)\s+[^\n.]{3,100}|hledáme[^\n.]*na pozici[^\n.]+)"
AUDIENCE = r"(?i)\b(?:team|community|partners?|customers?|volunteers?|participants?|sponsors?)\b"


def opportunity_type(title: Column, description: Column, rules: list[tuple[str, str]] = OPPORTUNITIES, organizer: str = ORGANIZER, no_vacancy: str = NO_VACANCY, hiring: str = HIRING) -> Column:
    """X11: title patterns unless a person runs the thing; two-part statements; the generic clause last. Several kinds are a conflict."""
    from_title = [F.when(title.rlike("(?i)" + p) & (F.lit(kind == "talent_pool") | ~title.rlike(organizer)), F.lit(kind)) for kind, p in rules]
    text = F.coalesce(description, F.lit(""))
    # The long patterns are tried only on texts that hold their key words.
    pool = F.when(text.rlike(r"(?iu)nemáme zrovna|no (?:current|suitable|matching) "), F.when(text.rlike(no_vacancy), F.lit("talent_pool")))
    found = F.array_distinct(F.array_compact(F.array(*from_title, pool)))
    clause = F.when(text.rlike(r"(?iu)we are (?:hiring|seeking|looking for)|hledáme"), F.regexp_extract(text, hiring, 0)).otherwise(F.lit(""))
    generic = let(clause, lambda c: F.when((c != "") & ~c.rlike(AUDIENCE), F.lit("vacancy")))
    return let(found, lambda kinds: F.when(F.size(kinds) > 1, F.lit("conflict")).when(F.size(kinds) == 1, kinds[0]).otherwise(generic))


def native_facts(df: DataFrame, id_col: str, payload: str, paths: dict[str, str], suggestions: tuple[str, ...] = ()) -> DataFrame:
    """(id, field, value, path, method) for each path of the payload that has a value. Suggested fields are marked as such."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.get_json_object(payload, p).alias("value"), F.lit(p).alias("path"), F.lit("suggestion" if f in suggestions else "native").alias("method")) for f, p in paths.items()])
    return df.select(F.col(id_col), F.inline(F.filter(each, lambda x: x["value"].isNotNull() & (F.trim(x["value"]) != ""))))


def native_offers(low: Column, high: Column, currency: Column, period: Column, minor: bool = False) -> Column:
    """A pay offer, or null if the range is inverted, not positive or without a currency."""
    from tablewright.functions.values import minor_units, pay_period

    a, b = (minor_units(low, currency), minor_units(high, currency)) if minor else (low.cast("decimal(18,4)"), high.cast("decimal(18,4)"))
    good = currency.isNotNull() & (a > 0) & (b.isNull() | (b >= a))
    return F.when(good, F.struct(a.alias("low"), b.alias("high"), currency.alias("currency"), pay_period(period).alias("period")))


def scoped_offers(rows: DataFrame, id_col: str, ranges: str, countries: dict[str, str], cities: dict[str, tuple[str, str]], minor: bool = False) -> DataFrame:
    """(id, position, low, high, currency, period, component, place, label): an offer for each of a row's native pay ranges (min, max, currency, period, title as text).

    One end may be missing; ranges without any, upside down, or in minor units of a currency that is not known to have hundredths are refused. A currency that is no three letters
    is unknown. A title that is exactly a country or a known city scopes the offer (`place`, `label`); one that speaks of a base salary makes it that component; pay once or by the
    task, of no stated component, is a task reward."""
    from tablewright.functions.values import amount, pay_period

    each = rows.select(F.col(id_col), F.posexplode(ranges).alias("position", "r"))
    currency = F.upper(F.trim("r.currency"))
    each = each.select(id_col, "position", amount(F.col("r.min")).alias("low"), amount(F.col("r.max")).alias("high"), F.when(currency.rlike("^[A-Z]{3}$"), currency).alias("currency"), pay_period(F.col("r.period")).alias("period"), F.col("r.title").alias("title"))
    if minor:
        each = each.where(F.col("currency").isin(*MINOR_UNITS)).withColumns({c: (F.col(c) / 100).cast("decimal(18,4)") for c in ("low", "high")})
    each = each.where(F.coalesce("low", "high").isNotNull() & ~F.coalesce(F.col("low") > F.col("high"), F.lit(False)))
    name = fold_spaces(F.col("title"))
    place = F.coalesce(mapped(name, countries), mapped(name, {k: c for k, (c, _) in cities.items()}))
    component = F.when(F.col("title").rlike("(?i)base salary"), "base").when(F.col("period").isin("one_time", "task"), "task_reward").otherwise("unknown")
    return each.select(id_col, "position", "low", "high", "currency", "period", component.alias("component"), place.alias("place"), F.when(place.isNotNull(), F.col("title")).alias("label"))
