"""Reference dimensions and review policies: small reviewed tables, checked when they are loaded."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.text import LEGAL_SUFFIXES, fold_spaces

#: Country names and codes that feeds use.
COUNTRY_ALIASES = {
    "cz": "CZ", "cze": "CZ", "czechia": "CZ", "czech republic": "CZ", "ceska republika": "CZ", "cesko": "CZ",
    "de": "DE", "germany": "DE", "deutschland": "DE", "nemecko": "DE",
    "fr": "FR", "france": "FR", "gb": "GB", "uk": "GB", "united kingdom": "GB",
    "us": "US", "usa": "US", "united states": "US", "united states of america": "US",
    "pl": "PL", "poland": "PL", "sk": "SK", "slovakia": "SK", "at": "AT", "austria": "AT", "es": "ES", "spain": "ES",
    "ie": "IE", "ireland": "IE", "se": "SE", "sweden": "SE", "nl": "NL", "netherlands": "NL", "ch": "CH", "switzerland": "CH",
}
#: City spellings, their name and country.
CITY_ALIASES = {
    "prague": ("Prague", "CZ"), "praha": ("Prague", "CZ"), "brno": ("Brno", "CZ"), "ostrava": ("Ostrava", "CZ"), "pardubice": ("Pardubice", "CZ"),
    "kutna hora": ("Kutná Hora", "CZ"), "plzen": ("Plzeň", "CZ"), "pilsen": ("Plzeň", "CZ"), "liberec": ("Liberec", "CZ"), "olomouc": ("Olomouc", "CZ"),
    "hradec kralove": ("Hradec Králové", "CZ"), "ceske budejovice": ("České Budějovice", "CZ"), "zlin": ("Zlín", "CZ"),
    "roznov pod radhostem": ("Rožnov pod Radhoštěm", "CZ"), "usti nad labem": ("Ústí nad Labem", "CZ"),
}


#: The 14 regions of the country whose cities are known, as ISO 3166-2 names them, and their further spellings.
REGIONS = (
    "Praha, Hlavní město", "Středočeský kraj", "Jihočeský kraj", "Plzeňský kraj", "Karlovarský kraj", "Ústecký kraj", "Liberecký kraj",
    "Královéhradecký kraj", "Pardubický kraj", "Kraj Vysočina", "Jihomoravský kraj", "Olomoucký kraj", "Zlínský kraj", "Moravskoslezský kraj",
)
REGION_SPELLINGS = {
    "prague": "Praha, Hlavní město", "praha": "Praha, Hlavní město", "hlavni mesto praha": "Praha, Hlavní město",
    "central bohemian region": "Středočeský kraj", "south bohemian region": "Jihočeský kraj",
    "south moravian region": "Jihomoravský kraj", "moravian-silesian region": "Moravskoslezský kraj",
    "pilsen region": "Plzeňský kraj", "plzen region": "Plzeňský kraj",
    "karlovy vary region": "Karlovarský kraj", "usti nad labem region": "Ústecký kraj",
    "liberec region": "Liberecký kraj", "hradec kralove region": "Královéhradecký kraj",
    "pardubice region": "Pardubický kraj", "olomouc region": "Olomoucký kraj",
    "zlin region": "Zlínský kraj", "vysocina region": "Kraj Vysočina",
}


def folded(name: str) -> str:
    """What fold_spaces gives for a name."""
    plain = unicodedata.normalize("NFD", name.lower())
    return " ".join("".join(c for c in plain if not unicodedata.combining(c)).split())


REGION_ALIASES = {folded(name): name for name in REGIONS} | REGION_SPELLINGS


def iso_countries(spark: SparkSession) -> DataFrame:
    """(alias, country): codes of two and three letters and English names of all ISO 3166 countries, as the session's Java knows them."""
    locale = spark.sparkContext._jvm.java.util.Locale
    rows = set()
    for code in locale.getISOCountries():
        one = locale("", code)
        rows |= {(code.lower(), code), (one.getISO3Country().lower(), code), (one.getDisplayCountry(locale.ENGLISH), code)}
    known = spark.createDataFrame(sorted(rows), "alias string, country string").select(fold_spaces(F.col("alias")).alias("alias"), "country")
    own = spark.createDataFrame(list(COUNTRY_ALIASES.items()), "alias string, country string")
    return own.unionByName(known.join(own.select("alias"), "alias", "left_anti"))


def subdivisions(spark: SparkSession, path: str) -> DataFrame:
    """(country, alias, name) of a file of the public ISO 3166-2 list, in the layout of Debian's iso-codes package (iso_3166-2.json: an object whose `3166-2` lists
    code, name and type). An alias that one country has twice means its code first, then its name, then its code without the country; of equals the smaller code."""
    rows = spark.read.option("multiLine", True).schema("`3166-2` array<struct<code: string, name: string, type: string>>").json(path).select(F.explode("3166-2").alias("r")).select("r.*")
    own = F.substring_index("code", "-", 1)
    ways = F.array(*[F.struct(F.lit(rank).alias("rank"), fold_spaces(alias).alias("alias")) for rank, alias in enumerate((F.col("code"), F.col("name"), F.regexp_replace("code", "^[^-]*-", "")))])
    each = rows.select(own.alias("country"), "code", "name", F.explode(ways).alias("way")).select("country", "way.*", "code", "name").where("alias <> ''")
    return each.groupBy("country", "alias").agg(F.min_by("name", F.struct("rank", "code")).alias("name"))


#: The key of each dimension.
KEYS = {"countries": ("alias",), "regions": ("alias",), "cities": ("alias",), "subdivisions": ("country", "alias"), "legal_suffixes": ("suffix",)}


def check_dimension(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(key, problem): keys that are blank or stand more than once."""
    text = F.concat_ws(":", *key)
    blank = F.lit(False)
    for k in key:
        blank = blank | F.col(k).isNull() | (F.trim(k) == "")
    each = rows.groupBy(*key).agg(F.count("*").alias("n"))
    return each.select(text.alias("key"), F.when(blank, "blank_key").when(F.col("n") > 1, "duplicate_key").alias("problem")).where("problem IS NOT NULL")


def load_dimension(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A dimension by name: countries, regions, cities, legal_suffixes, or subdivisions from the file at `path`. Blank or repeated keys are refused."""
    made = {
        "countries": lambda: iso_countries(spark),
        "regions": lambda: spark.createDataFrame(list(REGION_ALIASES.items()), "alias string, region string"),
        "cities": lambda: spark.createDataFrame([(k, *v) for k, v in CITY_ALIASES.items()], "alias string, city string, country string"),
        "legal_suffixes": lambda: spark.createDataFrame([(s,) for s in LEGAL_SUFFIXES], "suffix string"),
        "subdivisions": lambda: subdivisions(spark, path),
    }
    if name not in made:
        raise KeyError(name)
    rows = made[name]()
    bad = check_dimension(rows, KEYS[name]).limit(5).collect()
    if bad:
        raise ValueError(f"{name}: {[(r['key'], r['problem']) for r in bad]}")
    return rows


def check_policies(policies: DataFrame, states: tuple[str, ...], key: list[str], most_days: int = 31) -> DataFrame:
    """Violations: repeated keys, states that are not listed, dates out of order or too far apart."""
    repeated = policies.groupBy(*key).count().where("count > 1").select(*key, F.lit("duplicate_key").alias("problem"))
    span = F.unix_seconds("review_expires_at") - F.unix_seconds("reviewed_at")
    problem = F.when(~F.col("state").isin(*states), "unknown_state").when(span <= 0, "dates_out_of_order").when(span > most_days * 86400, "review_too_long")
    return repeated.unionByName(policies.select(*key, problem.alias("problem")).where("problem IS NOT NULL"))
