"""Text scanners as Column expressions.

Patterns use possessive quantifiers, so every scan is linear in the text.
`(?U)` makes digits and white space Unicode-wide. Null in, null out unless a
function says otherwise; array results are empty where nothing is found.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that say what counts as an amount, a factor, a phrase or a year.
MONEY = r"(?U)\$\s?+\d++(?:,\d++)*+(?:\.\d++)?+"
PERCENT_TOKEN = r"(?U)\d++(?:\.\d++)?+\s?+%?+"
FACTOR = r"(?<![\d.])\d\.\d{2,4}(?!\d)"
RATE_PHRASE = r"(rates? (is|are|of)|percentage|factor|multiplied by|gross[\x{2011}-]up|indexation factor)"
THRESHOLD_PHRASE = r"(threshold|limit|cap|maximum|minimum|exceeds|does not exceed|tax[\x{2011}-]free)"
INDEX_PHRASE = r"(index(ed|ation)|CPI|consumer price index|AWOTE|average weekly ordinary time earnings)"
YEAR = r"\b(?:19|20)\d{2}[\x{2011}-]\d{2}\b|\b(?:19|20)\d{2}\b"
OWNERSHIP_PHRASES = [
    "continuity of ownership", "beneficial own", "beneficial entitled", "beneficially own", "beneficially entitled",
    "wholly-owned", "wholly‑owned", "majority-owned", "majority‑owned",
]
OWNERSHIP_LEFT = ["voting", "dividend", "capital", "ownership", "control", "equity"]
OWNERSHIP_RIGHT = ["interest", "right", "stake", "power"]
SENTENCE_END = r"(?U)(?<=[.;:])\s+(?=[A-Z(\x{2022}*])|\n{2,}"
SENTENCE_LENGTH = (15, 600)
FOLDED_DASHES = "‑‐‒–—"
# Topics in order; the first whose pattern is found holds.
TOPICS = [
    ("customs tariff schedules", r"customs tariff|tariff (classification|schedule|item)|chapter \d+ .*(goods|articles)"),
    ("excise and fuel", r"excise|fuel tax credit|diesel|petroleum product"),
    ("income tax rates", r"income tax.*rate|rates act|marginal rate|tax[\x{2011}-]free threshold|resident taxpayer|non[\x{2011}-]resident.*rate"),
    ("medicare levy", r"medicare"),
    ("fringe benefits tax", r"fringe benefit|(?<![A-Za-z])FBT(?![A-Za-z])|gross[\x{2011}-]up"),
    ("superannuation", r"superannuation|super(annuation)? (guarantee|contribution|fund)|concessional cap|transfer balance|(?<![A-Za-z])SMSF(?![A-Za-z])"),
    ("gst and indirect", r"goods and services tax|(?<![A-Za-z])GST(?![A-Za-z])|wine equalisation|luxury car tax"),
    ("capital gains", r"capital gain|(?<![A-Za-z])CGT(?![A-Za-z])|cost base|discount capital"),
    ("capital allowances and depreciation", r"depreciat|capital allowance|decline in value|effective life|car limit|low[\x{2011}-]value pool"),
    ("companies and franking", r"franking|imputation|dividend|company tax|corporate tax rate|base rate entity"),
    ("trusts and partnerships", r"(?<![A-Za-z])trust(?![A-Za-z])|trustee|partnership|beneficiary"),
    ("deductions and offsets", r"deduction|offset|rebate|substantiat|entertainment|gift|donation"),
    ("withholding and PAYG", r"withholding|(?<![A-Za-z])PAYG(?![A-Za-z])|tax file number|instal?ment"),
    ("family assistance", r"family assistance|family tax benefit|child care"),
    ("petroleum and mining", r"petroleum resource rent|minerals resource rent|mining"),
    ("R&D and incentives", r"research and development|(?<![A-Za-z])R&D(?![A-Za-z])|incentive|concession"),
    ("small business", r"small business|aggregated turnover"),
    ("administration and penalties", r"penalt|shortfall|general interest charge|(?<![A-Za-z])GIC(?![A-Za-z])|(?<![A-Za-z])SIC(?![A-Za-z])|administrative|objection|assessment"),
    ("international", r"foreign|non[\x{2011}-]resident|transfer pricing|thin capitalisation|double tax|treaty"),
]
TOPIC_BODY = 300


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def stripped(c: Column) -> Column:
    """Without white space at either end, line ends and no-break spaces included."""
    return F.regexp_replace(c, r"(?U)^\s++|\s++$", "")


def word_count(c: Column) -> Column:
    """Words between white space; 0 for an empty text, null for null."""
    return F.size(_all(c, r"(?U)\S++"))


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def _all_if(c: Column, sign: str, pattern: str) -> Column:
    """Matches of a pattern that needs a sign; a text without it is not scanned. Null stays null."""
    return F.when(~c.contains(sign), F.array().cast("array<string>")).otherwise(_all(c, pattern))


def money_values(c: Column) -> Column:
    """Dollar amounts as written, in order."""
    return _all_if(c, "$", MONEY)


def has_money(c: Column) -> Column:
    return c.contains("$") & c.rlike(MONEY)


def has_percentage(c: Column) -> Column:
    """Whether percentage_values is not empty: a digit before a per cent sign always ends a token."""
    return c.contains("%") & c.rlike(r"(?U)\d\s?%")


def percentage_values(c: Column) -> Column:
    """Percentages as written: the longest decimal token that a per cent sign follows."""
    return F.filter(_all_if(c, "%", PERCENT_TOKEN), lambda x: x.endswith("%"))


def factor_values(c: Column) -> Column:
    """Bare factors: one digit, a point, two to four digits."""
    return _all_if(c, ".", FACTOR)


def has(c: Column, pattern: str) -> Column:
    return c.rlike("(?i)" + pattern)


def years(c: Column) -> Column:
    """Distinct years and year ranges, sorted."""
    return F.array_sort(F.array_distinct(_all(c, YEAR)))


def is_ownership_test(c: Column) -> Column:
    """Whether a text states an ownership or control test rather than a rate."""
    low = F.lower(c)
    phrase = "|".join(OWNERSHIP_PHRASES)
    pair = f"({'|'.join(OWNERSHIP_LEFT)}) ({'|'.join(OWNERSHIP_RIGHT)})"
    stake = r"(?U)\d\s?% (stake|subsidiary|interest)(?!\p{L})"
    return low.rlike(f"{phrase}|{pair}") | low.rlike(stake)


def haystack(act: Column, heading: Column, body: Column) -> Column:
    """What a topic is looked for in: heading, start of the body and act; nulls count as empty."""
    return F.concat_ws(" ", F.coalesce(heading, F.lit("")), F.substring(F.coalesce(body, F.lit("")), 1, TOPIC_BODY), F.coalesce(act, F.lit("")))


def topic_of(hay: Column) -> Column:
    """The first topic whose pattern a haystack holds; `other` if none. Give it a column, so that it is made once."""
    case = F.lit("other")
    for name, pattern in reversed(TOPICS):
        case = F.when(has(hay, pattern), name).otherwise(case)
    return case


def topic_for(act: Column, heading: Column, body: Column) -> Column:
    """topic_of(haystack(...)) as one expression."""
    return topic_of(haystack(act, heading, body))


def plain_lines(c: Column) -> Column:
    """The text without table lines."""
    return F.array_join(F.filter(lines(c), lambda x: ~x.startswith("|")), "\n")


def sentences(c: Column) -> Column:
    """Sentences outside tables, of more than 15 and fewer than 600 characters."""
    least, most = SENTENCE_LENGTH
    pieces = F.transform(F.split(plain_lines(c), SENTENCE_END, -1), stripped)
    return F.filter(pieces, lambda x: (F.char_length(x) > least) & (F.char_length(x) < most))


def table_blocks(c: Column) -> Column:
    """Contiguous runs of lines that start with a pipe."""
    return F.transform(_all(c, r"(?md)(?:^\|[^\n]*+\n?+)++"), lambda x: F.regexp_replace(x, r"\n\z", ""))


def fold(c: Column) -> Column:
    """Dashes as hyphens, no-break spaces as spaces."""
    return F.translate(c, FOLDED_DASHES + " ", "-" * len(FOLDED_DASHES) + " ")


def keywords_in(name: Column, keywords: list[str]) -> Column:
    """The keywords found in a name, each not preceded by a letter, in the given order; null names have none."""
    found = [F.when(has(F.coalesce(name, F.lit("")), f"(?<![A-Za-z])\\Q{k}\\E"), F.lit(k)) for k in keywords]
    return F.array_compact(F.array(*found))


def section_label(heading: Column) -> Column:
    """The number a section heading starts with: `a-b` around a no-break hyphen, else a plain one; null if none."""
    dashed = r"(\d{1,3}[A-Z]{0,4})\s*\x{2011}\s*(\d{1,4}[A-Z]{0,8})"
    plain = r"^\s*(\d{1,4}[A-Z]{0,8})(?=[.\s\x{00A0}\x{2011}]|$)"
    a, b, p = F.regexp_extract(heading, dashed, 1), F.regexp_extract(heading, dashed, 2), F.regexp_extract(heading, plain, 1)
    return F.when(a != "", F.concat_ws("-", a, b)).when(p != "", p)


def diagnostic(c: Column, limit: int = 80) -> Column:
    """One printable line of at most `limit` characters for a log; `?` if nothing is left."""
    flat = F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\x20-\x7E\x{A1}-\x{10FFFF}]", " "), " {2,}", " "))
    return F.when(F.coalesce(flat, F.lit("")) == "", "?").otherwise(F.substring(flat, 1, limit))


def cell(c: Column, limit: int) -> Column:
    """A text as a markdown table cell: pipes escaped, line ends as spaces, cut to `limit`."""
    return F.left(F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")), F.lit(limit))


def thousands_text(n: Column) -> Column:
    """A whole number with commas."""
    return F.format_number(n, 0)


def half_even_to(c: Column, unit: int) -> Column:
    """Rounded to a multiple of `unit`, halves to the even multiple."""
    return F.bround(c / unit, 0).cast("bigint") * unit


def iso_date(c: Column) -> Column:
    """A strict YYYY-MM-DD date; anything else is null."""
    return F.when(c.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date"))


def utc_timestamp(c: Column) -> Column:
    """An explicit-Z timestamp with at most six fraction digits; anything else is null."""
    shape = c.rlike(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z\z")
    return F.when(shape, F.try_to_timestamp(c))


def is_register_id(c: Column) -> Column:
    """A letter, four digits, a letter, five digits; null is not one."""
    return F.coalesce(c.rlike(r"\A[A-Z]\d{4}[A-Z]\d{5}\z"), F.lit(False))
