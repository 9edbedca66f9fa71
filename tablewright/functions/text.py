"""Text normalisation as native column expressions. The five folds differ on purpose and are not interchangeable."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _decomposed() -> dict[str, str]:
    """Letters below U+2000 whose canonical decomposition is one base letter and marks."""
    found = {}
    for code in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and all(unicodedata.combining(c) for c in parts[1:]):
            found[chr(code)] = parts[0]
    return found


_BASE = _decomposed()
_FROM, _TO = "".join(_BASE), "".join(_BASE.values())
#: Letters that have no decomposition but a customary plain spelling.
PLAIN = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ħ": "h", "ı": "i", "ŋ": "n", "ŧ": "t"}
#: Legal forms that end a company's name, after normalisation.
LEGAL_SUFFIXES = ("s r o", "sro", "a s", "as", "spol s r o", "se", "ltd", "limited", "llc", "inc", "gmbh")


def strip_marks(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _FROM, _TO), r"\p{M}", "")


def normalize_text(c: Column) -> Column:
    """No accents, lower case, everything else than letters and digits one space. Null gives the empty text."""
    c = strip_marks(F.lower(F.coalesce(c, F.lit(""))))
    for letter, plain in PLAIN.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def normalize_company(c: Column) -> Column:
    """N01 without one legal form at the end."""
    forms = "|".join(LEGAL_SUFFIXES)
    return F.trim(F.regexp_replace(normalize_text(c), rf"\s+({forms})$", ""))


def fold(c: Column) -> Column:
    """Lower case without marks; letters without a decomposition stay."""
    return strip_marks(F.lower(c))


def fold_spaces(c: Column) -> Column:
    """N03 with single spaces, trimmed."""
    return F.trim(F.regexp_replace(fold(c), r"(?U)\s+", " "))


def ascii_fold(c: Column, words_only: bool = False) -> Column:
    """N03 without anything that is not ASCII; on demand other than letters and digits become a space."""
    c = F.regexp_replace(fold(c), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " ")) if words_only else c


#: Compatibility letters that titles contain.
_COMPATIBLE = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in [*range(0xFF01, 0xFF5F), 0xA0, 0x2007, 0x202F, 0x3000] if len(unicodedata.normalize("NFKC", chr(c))) == 1}


def exact_title_key(c: Column) -> Column:
    """Compatibility forms resolved, single spaces, lower case. Accents stay."""
    c = F.translate(c, "".join(_COMPATIBLE), "".join(_COMPATIBLE.values()))
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whole words of `phrase` within `text`, both already normalised with single spaces."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, as the variable of a transform, however often `then` names it."""
    return F.transform(F.array(value), then)[0]


def padded_words(c: Column) -> Column:
    """Each word on a line of its own, with two spaces before and one behind it."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "\n"), "([a-z0-9]+)", "  $1 ")


def ordered_trigrams(c: Column) -> Column:
    """The trigrams of each word in order, padding included. A pattern that looks ahead finds the overlapping trigrams of all lines in one pass."""
    return F.regexp_extract_all(padded_words(c), F.lit(r"(?=([^\n]{3}))"), F.lit(1))


def trigrams(c: Column) -> Column:
    """The distinct ones of `ordered_trigrams`."""
    return F.array_distinct(ordered_trigrams(c))


def trigram_codes(c: Column) -> Column:
    """N08's trigrams as numbers, one for each: arrays of them are small and quick to intersect."""
    return F.transform(trigrams(c), lambda g: F.ascii(g) * 65536 + F.ascii(F.substring(g, 2, 1)) * 256 + F.ascii(F.substring(g, 3, 1)))


def similarity_of(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of two arrays of distinct trigrams; 0 if both are empty. What they share is worked out once: it stands outside any condition."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0)), F.lit(0.0))


def with_similarity(df: DataFrame, a: str, b: str, name: str, where: Column | None = None) -> DataFrame:
    """`similarity_of` two columns as a new one; where `where` is false nothing is intersected. What they share is a generated row, which filters and selects that follow name and do not
    work out again."""
    shared = F.size(F.array_intersect(a, b))
    shared = shared if where is None else F.when(where, shared).otherwise(0)
    every = F.size(a) + F.size(b) - F.col("_shared")
    found = df.withColumn("_shared", F.explode(F.array(shared)))
    return found.withColumn(name, F.coalesce(F.col("_shared") / F.nullif(every, F.lit(0)), F.lit(0.0))).drop("_shared")


def similarity(a: Column, b: Column) -> Column:
    return similarity_of(trigrams(a), trigrams(b))


def strip_tags(c: Column, by: str = " ") -> Column:
    """Tags become `by`, common entities are decoded, white space collapses."""
    c = F.regexp_replace(c, "<[^>]*>", by)
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_url(c: Column) -> Column:
    """No fragment, no query, no slash at the end, lower case."""
    return F.lower(F.rtrim(F.split_part(F.split_part(c, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1)), F.lit("/")))


def redact(c: Column) -> Column:
    """Addresses, credentials and session tokens out of a message."""
    c = F.regexp_replace(c, r"https?://[^\s'\"<>]+", "[url]")
    c = F.regexp_replace(c, r"(?i)\b(password|passwd|token|secret|authorization|api[_-]?key)\b\s*[:=]\s*\S+", "$1=[redacted]")
    return F.regexp_replace(c, r"(?i)\b(jsessionid|session|sid)=[A-Za-z0-9._-]+", "$1=[redacted]")
