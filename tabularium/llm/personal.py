"""Personal information in free text: found, and replaced by typed placeholders.

Method: regular expressions propose spans, validators confirm them (Luhn for
payment cards, mod-97 for bank accounts, the weighted check sum of tax file
numbers, digit counts of phone and registration numbers), and words nearby
raise or lower a span's score; spans that reach the threshold are kept,
longest first where they overlap. Cheap searches decide which of the patterns
a text is tried with, and every step is linear in the text but for sorting.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6

# Weights of the tax file number's check sum, which must be a multiple of 11.
TFN_WEIGHTS = (1, 4, 3, 7, 5, 8, 6, 9, 10)

_SP = r"[ \t\u00a0\u2000-\u200a\u202f\u205f\u3000]"
_SEP = r"[ .\-\u00a0\u2000-\u200a\u202f\u2010\u2011]"

# What signs are spelt as in e-mail addresses, street types, titles.
_AT = rf"(?:@|{_SP}*(?:\(at\)|\[at\]|\{{at\}}){_SP}*)"
_DOT = rf"(?:\.|{_SP}*(?:\(dot\)|\[dot\]|\{{dot\}}){_SP}*)"
EMAIL = re.compile(rf"(?<![\w.+-])[A-Za-z0-9](?:[\w+.-]*[\w+-])?{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+(?![\w@])", re.I)
EMAIL_WORDS = re.compile(rf"(?<![\w.+-])[A-Za-z0-9](?:[\w+.-]*[\w+-])?{_SP}+at{_SP}+[A-Za-z0-9-]+(?:{_SP}+dot{_SP}+[A-Za-z0-9-]+)+\b", re.I)

PHONE = re.compile(
    rf"(?<![\d$])(?<!\d{_SEP})(?:"
    rf"\+61{_SEP}?(?:\(0\){_SEP}?)?\d(?:{_SEP}?\d){{8}}"
    rf"|\+61{_SEP}?\(0?\d\)(?:{_SEP}?\d){{8}}"
    rf"|\(0[2-8]\){_SEP}?\d{{4}}{_SEP}?\d{{4}}"
    rf"|0[235-8]{_SEP}?\d{{4}}{_SEP}?\d{{4}}"
    rf"|04\d{{2}}{_SEP}?\d{{3}}{_SEP}?\d{{3}}"
    rf"|1[389]00{_SEP}?\d{{3}}{_SEP}?\d{{3}}"
    rf"|13{_SEP}\d{{2}}{_SEP}\d{{2}}"
    rf")(?!{_SEP}?\d)"
)
#: Numbers of other countries, in international notation.
PHONE_ABROAD = re.compile(rf"(?<![\w+])\+(?!61)[1-9]\d{{0,2}}{_SEP}?(?:\(\d{{1,4}}\){_SEP}?)?\d(?:{_SEP}?\d){{6,11}}(?!{_SEP}?\d)")
CARD = re.compile(rf"(?<![\d$])(?<!\d{_SEP})[2-6]\d{{3}}(?:{_SEP}?\d){{9,15}}(?!{_SEP}?\d)")
IBAN = re.compile(r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w])")
NINE = re.compile(rf"(?<![\d$])(?<![\d$]{_SEP})\d{{3}}({_SEP}?)\d{{3}}\1\d{{3}}(?!{_SEP}?\d)(?!\.\d)")
EIGHT = re.compile(r"(?<![\w$,.-])\d{8}(?![\w,]?\d|%)")
TRAVEL = re.compile(rf"(?i:\b(?:passport|travel{_SP}+document)s?(?:{_SP}+(?:number|no\.?|num\.?))?{_SP}*[:\u2013-]?{_SP}*)([A-Za-z]{{1,2}}{_SP}?\d{{7,8}})\b")

_STREET = (
    "Street|St|Road|Rd|Avenue|Ave|Av|Lane|Ln|Drive|Dr|Drv|Court|Ct|Crescent|Cres|Cr|Parade|Pde|Terrace|Tce|Ter|Place|Pl|"
    "Highway|Hwy|Close|Cl|Way|Boulevard|Blvd|Bvd|Circuit|Cct|Grove|Gr|Square|Sq|Esplanade|Esp|Walk|Row|Rise|Quay|Mews|Loop|Track"
)
_NUMBER = r"\d{1,5}[A-Za-z]?(?:-\d{1,5}[A-Za-z]?)?"
_INNER = rf"(?:{_SP}|,{_SP}*|{_SP}*\r?\n{_SP}*|,{_SP}*\r?\n{_SP}*)"
ADDRESS = re.compile(
    rf"(?<![\w$/.-])(?:(?:Unit|Level|Suite|Shop|Flat|Apartment|Apt|Floor|U|L){_SP}*\d{{1,4}}[A-Za-z]?(?:{_SP}*/{_SP}*|{_INNER}))?"
    rf"(?:Lot{_SP}+\d{{1,5}}[A-Za-z]?(?:,{_SP}*{_NUMBER})?|(?:\d{{1,4}}[A-Za-z]?/)?{_NUMBER})"
    rf"{_SP}+(?:[A-Z][\w'’-]*{_SP}+){{1,4}}?(?:{_STREET})\b\.?"
    rf"(?:{_INNER}(?:[A-Z][\w'’-]*{_SP}+){{0,3}}[A-Z][\w'’-]*,?{_SP}+[A-Z]{{2,3}}{_SP}+\d{{4}}(?!\d))?"
)
ADDRESS_CAPS = re.compile(ADDRESS.pattern, re.I)

_UP, _LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_CAP = rf"[{_UP}][{_LOW}]+"
_ONE = rf"(?:(?:Mc|Mac|[ODL]['’])?(?:{_CAP}|[{_UP}]{{2,}})|MC[{_UP}]{{2,}})"
_SUR = rf"{_ONE}(?:-{_ONE})*"
_GIV = rf"(?:{_CAP}(?:-{_CAP})?|[A-Z]\.)"
NAME = re.compile(
    rf"(?<![\w@.+/'’-])(?:"
    rf"(?P<inv>{_SUR},{_SP}+(?:{_CAP}|[A-Z]\.)(?:{_SP}+(?:{_CAP}|[A-Z]\.)(?![\w'’]))?)"
    rf"|(?P<nat>{_GIV}(?:{_SP}+{_GIV}){{0,2}}{_SP}+{_SUR})"
    rf")(?![\w@'’])(?!-\w)"
)

# Capitalised words that are no part of a person's name: function words and words of statutes, offices and
# organisations, calendar and money, streets and premises.
NOT_NAMES = frozenset(
    """
    the a an any each every that such its this these another no both all some on in at by of for to if where when unless despite until upon
    and or nor but with without within under over from before after during between records record penalty goods section subsection regulation
    clause item part division subdivision schedule chapter table volume act acts instrument notice determination rules rule declaration order
    notification regulations by-law bylaw principal second first third fourth tax taxes levy levies excise customs tariff superannuation
    medicare income services duty duties rates commissioner deputy assistant controller chief registrar inspector general state assessor
    revenue secretary valuation committee council panel review authority tribunal ombudsman board minister treasurer court federal commonwealth
    australian australia trust society association union club institute university school hospital church holdings group partners pty ltd
    limited company corporation inc proprietary bank insurance fund pension toll tolls dues fee fees charge charges
    street st road rd avenue ave lane ln drive dr court ct crescent cres parade pde terrace tce place pl highway hwy close way boulevard
    circuit grove square esplanade walk row unit level lot suite shop flat floor building house january february march april may june july august
    september october november december monday tuesday wednesday thursday friday saturday sunday contact attention telephone phone
    email fax mobile objections signed write quote send inquiries enquiries service locality registration registrations agent agents
    address name names rate matter amount answer question receipt reference folio file list dear note notes example
    transitional provisions provision scheme refund forms approved reporting entities entity administration consolidated exemptions machinery
    contributions imposition validation indexation factors thresholds renewals terminations suspensions rebate adjustment number figure
    mr mrs ms miss dr prof sir dame hon small holders
    """.split()
)
# Words of places, which are surnames too: no name by themselves, but one after a title.
PLACES = frozenset(
    """
    north south east west northern southern eastern western upper lower old new mount mt lake river creek bay port cape glen fort saint point
    valley hill hills island beach bridge harbour wharf dock basin reef lighthouse terminal depot station airport forest park field fields
    """.split()
)
_TITLE = re.compile(rf"\b(?:Mr|Mrs|Ms|Miss|Mx|Dr|Prof)\.?{_SP}+$")
_BEFORE = re.compile(
    rf"(?i)(?:issued to|signed by|delegates? (?:is|are)|attention:|attn:?|objections go to|in the matter of|decision about|inquiries to|contact:?|"
    rf"heard|on behalf of|appointed|witness(?:es)?:?|agent:?|;|\||\d{{8}}){_SP}*(?:(?:Mr|Mrs|Ms|Miss|Mx|Dr|Prof)\.?{_SP}+)?$"
)
_AFTER = re.compile(
    rf"(?:{_SP}*[|;(]|{_SP}+[\u2013-]{_SP}+\d|,{_SP}+(?:of\b|whose\b|passport|travel|TFN|tax|Tax|the (?:number|identifier|personal)|\d|Lot\b|Unit\b|Level\b)|{_SP}+and their assigns|{_SP}*\r?\n{_SP}*(?:\d|Unit|Level|Lot))"
)
_NOT_PERSON_AFTER = re.compile(
    rf"{_SP}+(?:Holdings|Pty|Ltd|Limited|Trust|Society|Act|Acts|Regulations?|Instrument|Notice|Rules|Determination|Order|Street|St|Road|Rd|Avenue|Ave|Lane|Court|"
    rf"Crescent|Cres|Parade|Terrace|Tce|Highway|Hwy|Way|Basin|Terminal|Scheme|Tax|Levy|Excise|Customs|Tariff|\()(?=\W)"
)
_CAPITAL = re.compile(rf"[A-Z][a-z]+{_SP}$")
_THE = re.compile(rf"(?i)\b(?:the|an?|any|each|such|that|its|another|of|at|held at|stored at|measured at){_SP}+$")
_NOT_ID = re.compile(rf"(?i)(?:receipts?|folio(?:{_SP}+is)?|(?<!tax.)file(?:{_SP}+is)?|reference|ref\.?|invoice|business|abn|acn|account|docket|case)(?:{_SP}+(?:is|no\.?|number))?{_SP}*[:#]?{_SP}*$")
_IS_AGENT = re.compile(rf"(?i)(?:regist\w*|agent|reg\.?)(?:{_SP}+(?:no\.?|number|num\.?|agent|as|is))*{_SP}*[:#]?{_SP}*$")


def plausible_tfn(digits: str) -> bool:
    """Whether nine digits satisfy the check sum."""
    return len(digits) == 9 and sum(w * int(d) for w, d in zip(TFN_WEIGHTS, digits)) % 11 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _line(text: str, start: int, end: int) -> tuple[int, int]:
    a = text.rfind("\n", 0, start) + 1
    b = text.find("\n", end)
    return a, len(text) if b < 0 else b


def luhn(digits: str) -> bool:
    """Whether the last digit of a payment card number checks the others."""
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return 13 <= len(digits) <= 19 and total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an international bank account number leaves 1 modulo 97."""
    a = "".join(account.split()).upper()
    return 15 <= len(a) <= 34 and a.isalnum() and a.isascii() and int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97 == 1


def _unusable(words: list[str], titled: bool) -> int | None:
    """The first word that cannot be part of a name; a title right before outweighs words of places."""
    barred = NOT_NAMES if titled else NOT_NAMES | PLACES
    return next((k for k, w in enumerate(words) if len(w) > 1 and any(p.lower() in barred for p in (w, *w.split("-")))), None)


_GAP = re.compile(rf"{_SP}+")
_JOINED_BEFORE, _JOINED_AFTER = re.compile(rf"(?:\band|,){_SP}+$"), re.compile(rf"{_SP}+and{_SP}")
_RUNNING = re.compile(rf"(?<![A-Z])[a-z]{{2,}},?{_SP}+$")


#: Where a name may start: a capitalised word before another one.
_PAIR = re.compile(rf"[{_UP}](?<![\w@.+/'’-].)[\w.'’-]*+,?{_SP}+(?=[{_UP}])")


def _names(text: str) -> list[tuple[int, int, str, float]]:
    found = []
    at = 0
    while pair := _PAIR.search(text, at):
        m = NAME.match(text, pair.start())
        if m is None:
            at = pair.start() + 1
            continue
        s, e = m.span()
        value = m.group()
        before, after = text[max(0, s - 40) : s], text[e : e + 30]
        titled = _TITLE.search(before) is not None
        words = [w.strip(".,") for w in _GAP.split(value)]
        bad = _unusable(words, titled)
        if bad is not None:
            # go on behind the word that cannot be part of a name
            ends = [g.start() for g in _GAP.finditer(value)] + [len(value)]
            at = s + max(1, ends[bad])
            continue
        at = e
        inv = m.group("inv") is not None
        full = [w for w in words if len(w) > 1]
        caps = [w for w in full if w.isupper()]
        cued = _BEFORE.search(before) is not None
        score = 0.5
        if len(caps) == len(full) and not inv:
            score -= 0.4  # running text in capitals
        if inv or caps or len(full) < len(words):
            score += 0.2
        if titled:
            score += 0.4
        if cued:
            score += 0.3
        if _AFTER.match(after):
            score += 0.3
        if _JOINED_BEFORE.search(before) or _JOINED_AFTER.match(after):
            score += 0.15
        elif _RUNNING.search(before):
            score += 0.1  # capitalised in the middle of a sentence, by itself
        if _CAPITAL.search(before) and not titled:
            score -= 0.3  # the rest of a longer capitalised phrase
        if not cued and _THE.search(before):
            score -= 0.6
        if _NOT_PERSON_AFTER.match(after):
            score -= 1.0
        found.append((s, e, "name", score))
    return found


#: What has to be in a text for the patterns of numbers, and of addresses, to be tried.
_LONG_NUMBER = re.compile(r"\d(?:[ .\-()\u00a0\u2000-\u200a\u202f\u2010\u2011]{0,3}\d){5}")
_HOUSE = re.compile(rf"\d[A-Za-z]?{_SP}+(?!(?:January|February|March|April|May|June|July|August|September|October|November|December)\b)[A-Z]")
_ACCOUNT = re.compile(r"[A-Z][A-Z]\d\d ?[A-Z0-9]{4}")


def _numbers(text: str, out: list) -> list[tuple[int, int, str, float]]:
    """Adds phone, card and identity numbers to `out`; returns the numbers whose score hangs on a name in their line."""
    other = lambda m: bool(_NOT_ID.search(text, max(0, m.start() - 30), m.start()))
    out += [(*m.span(), "phone", 0.8 - 0.6 * other(m)) for p in (PHONE, PHONE_ABROAD) for m in p.finditer(text)]
    out += [(*m.span(), "card", 0.7 - 0.6 * other(m)) for m in CARD.finditer(text) if luhn(_digits(m.group()))]
    out += [(*m.span(), "idnumber", 0.8 - 0.6 * other(m)) for m in NINE.finditer(text) if plausible_tfn(_digits(m.group()))]
    late = []
    for m in EIGHT.finditer(text):
        before = text[max(0, m.start() - 40) : m.start()]
        late.append((*m.span(), "idnumber", 0.3 + 0.6 * bool(_IS_AGENT.search(before)) - 1.0 * bool(_NOT_ID.search(before))))
    return late


def propose(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of every candidate, before overlaps are resolved."""
    out: list[tuple[int, int, str, float]] = []
    lower = text.lower()
    if "@" in text or "at)" in lower or "at]" in lower or "at}" in lower:
        out += [(*m.span(), "email", 1.0) for m in EMAIL.finditer(text)]
    if " dot " in lower:
        out += [(*m.span(), "email", 0.9) for m in EMAIL_WORDS.finditer(text)]
    late = _numbers(text, out) if _LONG_NUMBER.search(text) else []
    if "passport" in lower or "travel" in lower:
        out += [(*m.span(1), "idnumber", 0.9) for m in TRAVEL.finditer(text)]
    if _ACCOUNT.search(text):
        out += [(*m.span(), "iban", 0.9) for m in IBAN.finditer(text) if mod97(m.group())]
    if house := _HOUSE.search(text):
        address = ADDRESS_CAPS if text.isupper() else ADDRESS
        # what comes before the house number (unit, level, lot) is short
        out += [(*m.span(), "address", 0.9) for m in address.finditer(text, max(0, house.start() - 80))]
    names = _names(text)
    out += names
    likely = [s for s, _, _, score in names if score >= THRESHOLD - 0.3]
    ends = [e for _, e, _, score in names if score >= THRESHOLD - 0.3]
    for s, e, kind, score in late:
        a, b = _line(text, s, e)
        k = bisect_left(likely, a)  # names do not overlap, so the first that starts in the line ends first
        out.append((s, e, kind, score + 0.4 * (k < len(ends) and ends[k] <= b)))
    return out


def spans(text: str | None, threshold: float = THRESHOLD) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the confirmed items in order of their start; overlaps go to the longer span."""
    if not text:
        return []
    taken: list[tuple[int, int, str]] = []  # in order, without overlaps
    for s, e, kind, score in sorted(propose(text), key=lambda x: (x[0] - x[1], -x[3], x[0])):
        if score < threshold:
            continue
        k = bisect_left(taken, (s,))
        if (k == len(taken) or taken[k][0] >= e) and (k == 0 or taken[k - 1][1] <= s):
            insort(taken, (s, e, kind))
    return taken


def _placeholders(text: str, items: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, kind in items:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


def redact(text: str | None, threshold: float = THRESHOLD) -> str | None:
    """The text with every item replaced by [KIND]; null stays null."""
    return text if not text else _placeholders(text, spans(text, threshold))


def find_personal(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, value, start) of every item, value as written. Null and empty texts give no rows; repeated rows repeat theirs."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = src.schema["key"].dataType.simpleString()

    def work(batches):
        for b in batches:
            rows = [(i, k, t[s:e], s) for i, t in enumerate(b.column(1).to_pylist()) if t for s, e, k in spans(t)]
            at, kinds, values, starts = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(starts, pa.int32())],
                names=["key", "kind", "value", "start"],
            )

    return src.mapInArrow(work, f"key {kind}, kind string, value string, start int").withColumnRenamed("key", key)


def redact_personal(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, items): the text with typed placeholders and how many were put in.

    A null text stays null with 0 items; keys may repeat or be null; other
    columns are ignored.
    """
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = src.schema["key"].dataType.simpleString()

    def work(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [spans(t) for t in texts]
            done = [t if not f else _placeholders(t, f) for t, f in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.string()), pa.array([len(f) for f in found], pa.int32())], names=["key", "text", "items"])

    return src.mapInArrow(work, f"key {kind}, text string, items int").withColumnsRenamed({"key": key, "text": text})
