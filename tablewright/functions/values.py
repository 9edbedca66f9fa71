"""Scalar rules for money, places, types and identities, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import ascii_fold, fold, similarity, with_similarity


def mapped(c: Column, values: dict[str, str], otherwise: str | None = None) -> Column:
    """A vocabulary lookup."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), c)
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


#: Fixed values.
PAY_PERIODS = {"hour": "hour", "hourly": "hour", "1 hour": "hour", "per hour": "hour", "day": "day", "daily": "day", "month": "month", "monthly": "month", "1 month": "month", "year": "year", "yearly": "year", "annual": "year", "annually": "year", "1 year": "year", "one-time": "one_time", "one time": "one_time", "task": "task"}
LEVELS = {"junior": "junior", "entry level": "entry", "entry-level": "entry", "senior": "senior", "mid": "mid", "intermediate": "mid", "staff": "staff", "principal": "principal"}
MODES = {"remote": "remote", "fully remote": "remote", "work from home": "remote", "on remote": "remote", "hybrid": "hybrid", "hybrid remote": "hybrid", "hybrid working": "hybrid", "on site": "onsite", "on-site": "onsite", "onsite": "onsite", "on-site only": "onsite", "office": "onsite"}
MINOR_UNITS = ("CZK", "EUR", "USD", "GBP", "SEK", "PLN", "CHF")


def pay_period(c: Column) -> Column:
    return mapped(F.trim(fold(c)), PAY_PERIODS, "unknown")


def native_level(c: Column) -> Column:
    return mapped(F.trim(fold(c)), LEVELS)


def workplace_mode(c: Column) -> Column:
    return mapped(F.replace(F.trim(fold(c)), F.lit("_"), F.lit(" ")), MODES)


def first_match(c: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the first pattern that matches."""
    out = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(c.rlike(pattern), F.lit(label)).otherwise(out)
    return out


#: Words of employment labels.
SCHEDULES = [(r"\bfull[ -]?time\b|plny uvazek", "full_time"), (r"\bpart[ -]?time\b|castecny uvazek|zkraceny uvazek", "part_time"), (r"\bshift work\b|smenny provoz", "shift")]
RELATIONSHIPS = [(r"\bintern(ship)?\b|\btrainee\b|\bstaz\b", "intern"), (r"\bcontractor\b|\bfreelance\b|self.employed|\bico\b", "contractor"), (r"\btemporary\b|docasn", "temporary"), (r"\bemployee\b|\bzamestnanec\b", "employee")]
DURATIONS = [(r"\bfixed[ -]?term\b|doba urcita", "fixed_term"), (r"\bpermanent\b|indefinite|doba neurcita", "permanent")]


def employment_values(c: Column) -> Column:
    """Schedule, relationship and duration that a label states."""
    f = F.replace(fold(c), F.lit("_"), F.lit(" "))
    return F.struct(first_match(f, SCHEDULES).alias("schedule"), first_match(f, RELATIONSHIPS).alias("relationship"), first_match(f, DURATIONS).alias("duration"))


#: How each feed says that work is remote (P06). Rules are tried in order; a rule is a pattern and what it means.
ANYWHERE = [("hybrid", "hybrid"), ("remote", "remote")]
MODE_RULES: dict[str, list[tuple[str, str]]] = {
    "smartrecruiters_direct": [("^true$", "remote")],
    "greenhouse_direct": ANYWHERE,
    "workable_direct": [*ANYWHERE, ("on.?site|office", "onsite")],
    "ashby_direct": [("^remote$", "remote"), ("^hybrid$", "hybrid"), ("^on ?site$", "onsite"), ("^true$", "remote")],
    "lever_direct": [("^on-?site$", "onsite"), ("^remote$", "remote"), ("^hybrid$", "hybrid")],
    "workday_direct": [("hybrid|partially remote", "hybrid"), ("remote", "remote"), ("^(?:on site|onsite|fully onsite|fully on site|in person)$", "onsite")],
    "fantastic_jobs_apify": [("^telecommute$", "remote"), *ANYWHERE, ("on-?site", "onsite")],
}
#: Feeds whose marks are read as they are written; in other feeds everything but letters and digits is a space.
AS_WRITTEN = ("lever_direct", "fantastic_jobs_apify")
GENERAL_MODES = [("hybrid", "hybrid"), (r"remote|home.?office|work from home", "remote"), (r"on.?site|office", "onsite")]


def remote_type(c: Column, feed: str | None = None) -> Column:
    """How a feed's own field states the mode of work; without a feed, hybrid before remote before onsite in any text. Else unknown."""
    f = F.lower(F.trim(c)) if feed in AS_WRITTEN else fold(c) if feed is None else ascii_fold(c, words_only=True)
    return F.coalesce(first_match(f, MODE_RULES.get(feed, GENERAL_MODES)), F.lit("unknown"))


def amount(c: Column) -> Column:
    """A positive number with thousands marks or a final k, else null."""
    low = F.lower(F.trim(c))
    plain = F.regexp_replace(low, r"[ , k]", "").try_cast("decimal(18,4)") * F.when(low.rlike("k$"), F.lit(1000)).otherwise(F.lit(1))
    plain = plain.cast("decimal(18,4)")
    return F.when(plain > 0, plain)


def minor_units(value: Column, currency: Column) -> Column:
    """Amounts that a feed gives in hundredths."""
    return F.when(currency.isin(*MINOR_UNITS), (value / 100).cast("decimal(18,4)")).otherwise(value.cast("decimal(18,4)"))


def _location_similarity(a: Column, b: Column, otherwise: Column) -> Column:
    return F.when((a == "") | (b == ""), F.lit(0.5)).when(a == b, F.lit(1.0)).when(F.contains(a, b) | F.contains(b, a), F.lit(0.95)).otherwise(otherwise)


def location_similarity(a: Column, b: Column) -> Column:
    """Unknown 0.50, equal 1.00, one within the other 0.95, else trigram similarity."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return _location_similarity(a, b, similarity(a, b))


def with_location_similarity(df: DataFrame, a: str, b: str, grams_a: str, grams_b: str, name: str) -> DataFrame:
    """N10 of two columns without nulls, whose trigrams are there already."""
    looked = ~F.contains(a, b) & ~F.contains(b, a)  # the empty text is within any other
    found = with_similarity(df, grams_a, grams_b, "_trigrams", looked)
    return found.withColumn(name, _location_similarity(F.col(a), F.col(b), F.col("_trigrams"))).drop("_trigrams")


def field_is_empty(name: str, c: Column, kind: str = "string") -> Column:
    """Null, blank, an unknown mode or an empty list."""
    if kind.startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    if kind != "string":
        return c.isNull()
    empty = c.isNull() | (F.trim(c) == "")
    return empty | (c == "unknown") if name == "remote_type" else empty


def semantic_hash(*columns: Column) -> Column:
    """A digest of named values in the order given; nulls are spelled out."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def ordered_distinct(c: Column) -> Column:
    return F.array_distinct(F.filter(c, lambda x: x.isNotNull() & (F.trim(x) != "")))


def location_text(*places: Column) -> Column:
    """Parts of a place joined by a comma, places by a bar; nothing twice."""
    labels = F.array(*[F.array_join(ordered_distinct(p), ", ") for p in places])
    return F.nullif(F.array_join(ordered_distinct(labels), " | "), F.lit(""))


def joined_description(parts: Column) -> Column:
    """P08 for an array: the parts that are not blank, a blank line between them."""
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (F.trim(x) != "")), "\n\n")


def description_text(*parts: Column) -> Column:
    """The parts that are not blank, a blank line between them."""
    return joined_description(F.array(*parts))


def salary_text(label: Column, low: Column, high: Column, currency: Column) -> Column:
    """The label, and the structured range as compact json."""
    data = F.when(low.isNotNull() | high.isNotNull(), F.to_json(F.struct(low.alias("min"), high.alias("max"), currency.alias("currency"))))
    return F.nullif(F.concat_ws(" ", F.nullif(F.trim(label), F.lit("")), data), F.lit(""))


FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "EEE, dd MMM yyyy HH:mm:ss Z", "EEE MMM dd HH:mm:ss z yyyy", "yyyy-MM-dd")


def parse_timestamp(c: Column) -> Column:
    """P10: ISO with or without a zone (then UTC), mail dates, the C library's form, dates; else null.

    Weekday names are checked by nobody: they are cut off, since the date decides."""
    bare = F.regexp_replace(F.trim(c), r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun),?\s+", "")
    tries = [F.try_to_timestamp(bare, F.lit(f.removeprefix("EEE, ").removeprefix("EEE "))) for f in FORMATS]
    return F.coalesce(*tries)


def age_days(now: Column, then: Column) -> Column:
    """Days between two times, fractions included."""
    return (F.unix_micros(now) - F.unix_micros(then)) / 86400e6


#: The shape of the id that each feed gives, after its scope.
ID_SHAPES = {"uuid": r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", "hex32": r"^[0-9A-Fa-f]{32}$", "digits": r"^[0-9]{1,20}$", "site": r"^[A-Za-z0-9][A-Za-z0-9_-]*$"}


def native_id(scope: list[Column], own: Column, shape: str) -> Column:
    """Scope and id joined by colons; null if a part is missing, holds a colon or has another shape."""
    good = own.rlike(ID_SHAPES[shape])
    for part in scope:
        good = good & part.isNotNull() & (part != "") & ~F.contains(part, F.lit(":"))
    return F.when(good, F.concat_ws(":", *scope, own))


def url_identity(url: Column, hosts: str, path: str, *names: str, schemes: str = "https", ports: tuple[int, ...] = (443,)) -> Column:
    """A struct of host and the groups of `path`, or null. The scheme must be one of `schemes` (a pattern), the port absent or one of
    `ports`, there must be no user, and the whole path must have the shape. Percent escapes that hide a separator or a step upwards are refused."""
    start = rf"^(?:{schemes})://"
    port = f"(?::(?:{'|'.join(map(str, ports))}))?" if ports else ""
    url = F.trim(url)
    host = F.lower(F.regexp_extract(url, rf"{start}([^/?#@:]+){port}(?=[/?#]|$)", 1))
    where = F.regexp_extract(url, rf"{start}[^/?#]+([^?#]*)", 1)
    good = host.rlike(hosts) & where.rlike(path) & ~where.rlike(r"(?i)%2f|%5c|%2e|\.\.|//")
    groups = [F.regexp_extract(where, path, k + 1).alias(n) for k, n in enumerate(names)]
    return F.when(good, F.struct(host.alias("host"), *groups))


def page_platform(url: Column, html: Column) -> Column:
    """The platform of a career page by its host and marks in its html."""
    return (
        F.when(F.contains(html, F.lit("data-careersite-propertyid")) | F.contains(html, F.lit("rmkcdn")), F.lit("rmk"))
        .when(F.contains(html, F.lit('itemtype="http://schema.org/JobPosting"')) | F.contains(html, F.lit('"JobPosting"')), F.lit("microdata"))
        .when(url.rlike(r"^https?://([^/]*\.)?example\.(com|org)(/|$)") & F.contains(html, F.lit("<article>")), F.lit("article"))
        .otherwise(F.lit("unknown"))
    )


def clearly_foreign(countries: Column, home: str) -> Column:
    """Every place states a country and none is `home`; without places not."""
    return (F.size(countries) > 0) & F.forall(countries, lambda c: c.isNotNull() & (c != home))


def ineligible_reason(countries: Column, home: str) -> Column:
    return F.when(F.size(countries) == 0, F.lit("missing_location")).when(clearly_foreign(countries, home), F.lit("foreign_location")).when(F.exists(countries, lambda c: c == home), F.lit(None).cast("string")).otherwise(F.lit("unknown_location"))


def region_evidence(country: Column, others: Column, label: Column, home: str, markers: list[str]) -> Column:
    """Which evidence makes a row eligible, or null. An explicit country decides; an explicit foreign one still yields to a
    different secondary place at home; only without any country do marker phrases in the label count."""
    pattern = r"(?<![\p{L}\p{N}])(" + "|".join(markers) + r")(?![\p{L}\p{N}])"
    return F.when(country == home, F.lit("country_code")).when(F.exists(others, lambda c: c == home), F.lit("secondary_country")).when(country.isNull() & fold(label).rlike(pattern), F.lit("label"))



