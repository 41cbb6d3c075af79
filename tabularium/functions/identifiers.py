"""Personal names, registration numbers and contact identifiers as Column expressions.

Raw identifiers never leave these functions in a report: contacts come out as
SHA-256 fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of names, numbers and contacts, and the statutory vocabulary.
_TOKEN = r"[A-Z][A-Za-z'\x{2019}-]{1,20}"
NAME = rf"(?U)\b{_TOKEN},?\s+{_TOKEN}(?:\s+{_TOKEN})?\b"
REGISTRATION = r"(?U)\b\d{8}\b"
EMAIL = r"(?U)\b[\w.+-]++@[\w-]+(?:\.[\w-]+)+\b"
PHONE = (
    r"(?U)(?<!\d)(?:\(0\d\)[\s-]?\d{4}[\s-]?\d{4}|0[2-8][\s-]?\d{4}[\s-]?\d{4}|04\d{2}[\s-]?\d{3}[\s-]?\d{3}"
    r"|\+61[\s-]?(?:\(0\)[\s-]?)?\d(?:[\s-]?\d){8}|\+61[\s-]?\(0?\d\)[\s-]?\d(?:[\s-]?\d){7}"
    r"|1[38]00[\s-]?\d{3}[\s-]?\d{3}|13[\s-]?\d{2}[\s-]?\d{2})(?!\d)"
)
TFN_LABELLED = r"(?iU)\b(?:tax file number|TFN)\b\s*(?:[.:\x{2013}-]\s*)?(\d(?:[\s-]?\d){7,8})(?![\s-]?\d)"
TFN_BARE = r"(?U)(?<![\d$])(?<![\d$][\s-])(\d{3}([\s-]?)\d{3}\2\d{3})(?![\s-]?\d)"
TFN_WEIGHTS = [1, 4, 3, 7, 5, 8, 6, 9, 10]
STATUTORY_WORDS = [
    "Act", "Regulation", "Schedule", "Division", "Subdivision", "Part", "Chapter", "Section", "Commissioner", "Minister", "Treasurer",
    "Commonwealth", "Australian", "Australia", "Board", "Tax", "Taxation", "Income", "Superannuation", "Court", "Tribunal", "Determination",
    "Notice", "Instrument", "Amendment", "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December",
]
CONTROL = r"[\x00-\x08\x0B\x0E-\x1F\x7F-\x9F]"


def _all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def is_statutory(c: Column) -> Column:
    """Whether a capitalised phrase is statute vocabulary; phrases with an all-capital word are compared without case."""
    words = "|".join(STATUTORY_WORDS)
    shouting = F.exists(F.split(c, "[^A-Za-z]+"), lambda t: (F.length(t) > 1) & (F.upper(t) == t))
    return c.rlike(rf"\b({words})\b") | (shouting & c.rlike(rf"(?i)\b({words})\b"))


def person_names(c: Column) -> Column:
    """Distinct name-shaped phrases that are not statutory, sorted."""
    return F.array_sort(F.array_distinct(F.filter(_all(c, NAME), lambda x: ~is_statutory(x))))


def registration_numbers(c: Column) -> Column:
    """Distinct standalone eight-digit numbers, sorted."""
    return F.array_sort(F.array_distinct(_all(c, REGISTRATION)))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def plausible_tfn(d: Column) -> Column:
    """Whether nine digits satisfy the weighted mod-11 check."""
    parts = F.transform(F.split(d, ""), lambda x: x.cast("int"))
    total = F.aggregate(F.zip_with(parts, F.array(*map(F.lit, TFN_WEIGHTS)), lambda a, b: a * b), F.lit(0), lambda x, y: x + y)
    return F.when(F.length(d) == 9, total % 11 == 0).otherwise(F.lit(False))


def phone_value(c: Column) -> Column:
    """Digits; international notation as the national number."""
    rest = F.substring(digits(c), 3, 20)
    return F.when(c.startswith("+61"), F.when(rest.startswith("0"), rest).otherwise(F.concat(F.lit("0"), rest))).otherwise(digits(c))


def contact_values(c: Column) -> Column:
    """array<struct<kind, value>> of e-mail, phone and tax file numbers, normalised.

    Labelled numbers are masked before the bare pattern runs, so none counts
    twice; a bare number needs a valid check digit.
    """
    masked = F.regexp_replace(c, TFN_LABELLED, "\u0001")
    item = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    # without an at sign there is nothing to scan for, and no long run of dots to try at every word
    email = F.transform(F.when(c.contains("@"), _all(c, EMAIL)).when(c.isNotNull(), F.array().cast("array<string>")), lambda x: item("email", F.lower(F.trim(x))))
    phone = F.transform(_all(c, PHONE), lambda x: item("phone", phone_value(x)))
    labelled = F.transform(_all(c, TFN_LABELLED, 1), lambda x: item("tfn", digits(x)))
    bare = F.filter(F.transform(_all(masked, TFN_BARE, 1), lambda x: item("tfn", digits(x))), lambda s: plausible_tfn(s["value"]))
    return F.concat(email, phone, labelled, bare)


def fingerprint(value: Column) -> Column:
    """SHA-256 of the normalised value, in hex."""
    return F.sha2(value, 256)


def has_control_bytes(c: Column) -> Column:
    """Whether a text holds control characters other than tab, line feed, carriage return and form feed."""
    return F.coalesce(c.rlike(CONTROL), F.lit(False))
