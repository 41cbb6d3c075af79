"""The SQL that the corpus queries are checked against; RE2 has no lookaround, so patterns are restated."""

from __future__ import annotations

# Fixed values, stated here anew so that the SQL does not depend on what it checks: titles searched for, phrases, vocabulary, topics.
KEYWORDS = ["Tax", "Excise", "Superannuation", "Customs Tariff", "Medicare Levy"]
COLLECTIONS = ["Act", "LegislativeInstrument", "NotifiableInstrument"]
YEAR = r"\b(?:19|20)[0-9]{2}[\x{2011}-][0-9]{2}\b|\b(?:19|20)[0-9]{2}\b"
RATE_PHRASE = r"rate (is|are|of)|rates (is|are|of)|percentage|factor|multiplied by|gross[\x{2011}-]up|indexation factor"
THRESHOLD_PHRASE = r"threshold|limit|cap|maximum|minimum|exceeds|does not exceed|tax[\x{2011}-]free"
INDEX_PHRASE = r"indexed|indexation|CPI|consumer price index|AWOTE|average weekly ordinary time earnings"
OWNERSHIP = (
    r"continuity of ownership|beneficial own|beneficial entitled|beneficially own|beneficially entitled|wholly[-\x{2011}]owned|majority[-\x{2011}]owned"
    r"|(voting|dividend|capital|ownership|control|equity) (interest|right|stake|power)"
)
STATUTORY = (
    "Act|Regulation|Schedule|Division|Subdivision|Part|Chapter|Section|Commissioner|Minister|Treasurer|Commonwealth|Australian|Australia|Board|Tax|Taxation|Income|"
    "Superannuation|Court|Tribunal|Determination|Notice|Instrument|Amendment|January|February|March|April|May|June|July|August|September|October|November|December"
)
TFN_WEIGHTS = [1, 4, 3, 7, 5, 8, 6, 9, 10]
FOLDED = "‑‐‒–—"
TOPICS = [
    ("customs tariff schedules", r"customs tariff|tariff (classification|schedule|item)|chapter \d+ .*(goods|articles)"),
    ("excise and fuel", r"excise|fuel tax credit|diesel|petroleum product"),
    ("income tax rates", r"income tax.*rate|rates act|marginal rate|tax[\x{2011}-]free threshold|resident taxpayer|non[\x{2011}-]resident.*rate"),
    ("medicare levy", r"medicare"),
    ("fringe benefits tax", r"fringe benefit|(^|[^A-Za-z])FBT([^A-Za-z]|$)|gross[\x{2011}-]up"),
    ("superannuation", r"superannuation|super(annuation)? (guarantee|contribution|fund)|concessional cap|transfer balance|(^|[^A-Za-z])SMSF([^A-Za-z]|$)"),
    ("gst and indirect", r"goods and services tax|(^|[^A-Za-z])GST([^A-Za-z]|$)|wine equalisation|luxury car tax"),
    ("capital gains", r"capital gain|(^|[^A-Za-z])CGT([^A-Za-z]|$)|cost base|discount capital"),
    ("capital allowances and depreciation", r"depreciat|capital allowance|decline in value|effective life|car limit|low[\x{2011}-]value pool"),
    ("companies and franking", r"franking|imputation|dividend|company tax|corporate tax rate|base rate entity"),
    ("trusts and partnerships", r"(^|[^A-Za-z])trust([^A-Za-z]|$)|trustee|partnership|beneficiary"),
    ("deductions and offsets", r"deduction|offset|rebate|substantiat|entertainment|gift|donation"),
    ("withholding and PAYG", r"withholding|(^|[^A-Za-z])PAYG([^A-Za-z]|$)|tax file number|instal?ment"),
    ("family assistance", r"family assistance|family tax benefit|child care"),
    ("petroleum and mining", r"petroleum resource rent|minerals resource rent|mining"),
    ("R&D and incentives", r"research and development|(^|[^A-Za-z])R&D([^A-Za-z]|$)|incentive|concession"),
    ("small business", r"small business|aggregated turnover"),
    ("administration and penalties", r"penalt|shortfall|general interest charge|(^|[^A-Za-z])GIC([^A-Za-z]|$)|(^|[^A-Za-z])SIC([^A-Za-z]|$)|administrative|objection|assessment"),
    ("international", r"foreign|non[\x{2011}-]resident|transfer pricing|thin capitalisation|double tax|treaty"),
]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WS = r"[\s\p{Z}\x{0085}]"
_MONEY = rf"\${_WS}?\p{{Nd}}+(?:,\p{{Nd}}+)*(?:\.\p{{Nd}}+)?"
_PERCENT = rf"\p{{Nd}}+(?:\.\p{{Nd}}+)?{_WS}?%?"


def money(t: str) -> str:
    return f"regexp_extract_all({t}, {q(_MONEY)})"


def percent(t: str) -> str:
    return f"list_filter(regexp_extract_all({t}, {q(_PERCENT)}), lambda z: z LIKE '%\\%' ESCAPE '\\')"


def factors(t: str) -> str:
    return f"list_transform(list_filter(regexp_extract_all({t}, '[0-9.]+'), lambda z: regexp_matches(z, '^[0-9]\\.[0-9]{{2,4}}(\\.|$)')), lambda z: regexp_extract(z, '^[0-9]\\.[0-9]{{2,4}}'))"


def years(t: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all({t}, {q(YEAR)})))"


def has(t: str, p: str) -> str:
    return f"regexp_matches({t}, {q('(?i)' + p)})"


def joined(e: str) -> str:
    return f"coalesce(array_to_string({e}, '|'), CASE WHEN {e} IS NOT NULL THEN '' END)"


def words(t: str) -> str:
    return f"len(regexp_extract_all({t}, {q('[^' + _WS[1:-1] + ']+')}))"


PLAIN = "array_to_string(list_filter(string_split(text, chr(10)), lambda z: NOT starts_with(z, '|')), chr(10))"
STRIP = rf"regexp_replace(regexp_replace(z, '^{_WS}+', ''), '{_WS}+$', '')"
SENTENCES = (
    f"list_filter(list_transform(string_split(regexp_replace(regexp_replace({PLAIN}, '([.;:]){_WS}+([A-Z(\\x{{2022}}*])', '\\1' || chr(1) || '\\2', 'g'), "
    f"'\\n{{2,}}', chr(1), 'g'), chr(1)), lambda z: {STRIP}), lambda z: length(z) > 15 AND length(z) < 600)"
)
BLOCKS = r"list_transform(regexp_extract_all(text, '(?m)(?:^\|[^\n]*\n?)+'), lambda z: regexp_replace(z, '\n$', ''))"
_OWNER = OWNERSHIP


def ownership(t: str) -> str:
    return f"(regexp_matches(lower({t}), {q(_OWNER)}) OR regexp_matches(lower({t}), '\\p{{Nd}}{_WS}?% (stake|subsidiary|interest)([^\\p{{L}}]|$)'))"


def topic() -> str:
    hay = "coalesce(heading, '') || ' ' || substring(coalesce(text, ''), 1, 300) || ' ' || coalesce(act, '')"
    cases = " ".join(f"WHEN {has('hay', p)} THEN {q(n)}" for n, p in TOPICS)
    return hay, f"CASE {cases} ELSE 'other' END"


HAY, TOPIC = topic()
ONCE = "once AS (SELECT * FROM sections QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
RECORDS = f"""
{ONCE},
op AS (SELECT *, {HAY} AS hay FROM once
       WHERE len({money('text')}) > 0 OR len({percent('text')}) > 0 OR (len({factors('text')}) > 0 AND {has('text', RATE_PHRASE)})),
rows_ AS (SELECT *, {TOPIC} AS topic FROM op),
tb AS (SELECT row_id, act, section, heading, collection, topic, 0 AS part, unnest(range(len(bs))) AS pos, unnest(bs) AS content FROM (SELECT *, {BLOCKS} AS bs FROM rows_)),
tables_ AS (SELECT *, 'table' AS kind, NULL::VARCHAR[] AS amounts, {years("replace(content, chr(10), ' ')")} AS years FROM tb
            WHERE len(string_split(content, chr(10))) >= 3 AND (len({money("replace(content, chr(10), ' ')")}) > 0 OR len({percent("replace(content, chr(10), ' ')")}) > 0)),
sn AS (SELECT row_id, act, section, heading, collection, topic, 1 AS part, unnest(range(len(ss))) AS pos, unnest(ss) AS content FROM (SELECT *, {SENTENCES} AS ss FROM rows_)),
sv AS (SELECT *, {money('content')} AS m, {percent('content')} AS p, CASE WHEN {has('content', RATE_PHRASE)} THEN {factors('content')} ELSE [] END AS f FROM sn),
said AS (SELECT row_id, act, section, heading, collection, topic, part, pos, content,
           CASE WHEN {has('content', INDEX_PHRASE)} THEN 'indexation' WHEN len(p) > 0 AND {ownership('content')} THEN 'ownership test' WHEN len(p) > 0 THEN 'rate'
                WHEN len(f) > 0 AND len(m) = 0 THEN 'factor' ELSE 'threshold' END AS kind,
           list_sort(list_distinct(list_concat(m, p, f))) AS amounts, {years('content')} AS years
         FROM sv WHERE (len(m) > 0 OR len(p) > 0 OR len(f) > 0)
           AND (len(p) > 0 OR {has('content', RATE_PHRASE)} OR {has('content', THRESHOLD_PHRASE)} OR {has('content', INDEX_PHRASE)})),
records AS (SELECT row_id, act, section, heading, collection, topic, part, pos, content, kind, amounts, years FROM tables_ UNION ALL SELECT row_id, act, section, heading, collection, topic, part, pos, content, kind, amounts, years FROM said)
"""


def fold(c: str) -> str:
    return f"translate({c}, {q(FOLDED + chr(0xA0))}, {q('-' * len(FOLDED) + ' ')})"


_TOK = r"[A-Z][A-Za-z'\x{2019}-]{1,20}"
_STAT = STATUTORY
_STATUTORY = (
    rf"(regexp_matches(z, '\b({_STAT})\b') OR (len(list_filter(regexp_split_to_array(z, '[^A-Za-z]+'), lambda y: length(y) > 1 AND upper(y) = y)) > 0 AND regexp_matches(z, '(?i)\b({_STAT})\b')))"
)
_NAME = rf"\b{_TOK},?{_WS}+{_TOK}(?:{_WS}+{_TOK})?\b"
NAMES = f"list_distinct(list_filter(regexp_extract_all(text, {q(_NAME)}), lambda z: NOT {_STATUTORY}))"
NUMBERS = r"list_distinct(regexp_extract_all(text, '\b[0-9]{8}\b'))"


def persons(src: str, n: int) -> str:
    return f"SELECT register_id, row_id, len({NAMES}) AS names, len({NUMBERS}) AS numbers, {words('text')} AS words FROM {src} WHERE len({NAMES}) >= {n} AND len({NUMBERS}) >= {n}"


_D, _G = r"[0-9]", r"[\s\p{Z}-]"
_EMAIL = r"\b[\w.+-]+@[\w-]+(?:\.[\w-]+)+\b"
_PHONE = (
    rf"(?:\(0\d\){_G}?\d{{4}}{_G}?\d{{4}}|0[2-8]{_G}?\d{{4}}{_G}?\d{{4}}|04\d{{2}}{_G}?\d{{3}}{_G}?\d{{3}}"
    rf"|\+61{_G}?(?:\(0\){_G}?)?\d(?:{_G}?\d){{8}}|\+61{_G}?\(0?\d\){_G}?\d(?:{_G}?\d){{7}}|1[38]00{_G}?\d{{3}}{_G}?\d{{3}}|13{_G}?\d{{2}}{_G}?\d{{2}})"
)
_TFN_END = r"(?:[^\d\s\p{Z}-]|[\s\p{Z}-](?:[^\d]|$)|$)"
_TFN = rf"(?i)\b(?:tax file number|TFN)\b[\s\p{{Z}}]*(?:[.:\x{{2013}}-][\s\p{{Z}}]*)?(\d(?:{_G}?\d){{7,8}}){_TFN_END}"
_BARE = "|".join(rf"\d{{3}}{x}\d{{3}}{x}\d{{3}}" for x in ("", "-", " ", r"\x{A0}"))
_BARE = rf"(?:^|[^\d$\s\p{{Z}}-]|(?:^|[^\d$])[\s\p{{Z}}-])({_BARE}){_TFN_END}"
_NINE = " + ".join(f"{w} * substring(v, {i + 1}, 1)::INT" for i, w in enumerate(TFN_WEIGHTS))


def contacts(src: str) -> str:
    """CTE contacts(register_id, row_id, kind, value): lookaround is said by what stands before and behind; texts are padded."""
    digits = lambda e: f"regexp_replace({e}, '[^0-9]', '', 'g')"
    each = lambda p, g=1: f"regexp_extract_all(t, {q(p)}, {g})"
    rest = digits("v") + "[3:]"
    return f"""
padded AS (SELECT register_id, row_id, ' ' || text || ' ' AS t FROM {src} WHERE text IS NOT NULL),
masked AS (SELECT register_id, row_id, regexp_replace(t, {q(_TFN.replace("(" + chr(92) + "d(?:", "(?:" + chr(92) + "d(?:").replace(_TFN_END, ""))}, chr(1), 'g') AS t FROM padded),
contacts AS (
 SELECT register_id, row_id, 'email' AS kind, lower(v) AS value FROM (SELECT *, unnest({each(_EMAIL, 0)}) AS v FROM padded)
 UNION ALL SELECT register_id, row_id, 'phone', CASE WHEN starts_with(v, '+61') THEN CASE WHEN starts_with({rest}, '0') THEN {rest} ELSE '0' || {rest} END ELSE {digits('v')} END
   FROM (SELECT *, unnest({each('(?:^|[^0-9])(' + _PHONE + ')(?:[^0-9]|$)')}) AS v FROM padded)
 UNION ALL SELECT register_id, row_id, 'tfn', {digits('v')} FROM (SELECT *, unnest({each(_TFN)}) AS v FROM padded)
 UNION ALL SELECT register_id, row_id, 'tfn', v FROM (SELECT register_id, row_id, {digits('v')} AS v FROM (SELECT *, unnest({each(_BARE)}) AS v FROM masked)) WHERE ({_NINE}) % 11 = 0)"""


_FLAGGED = "(SELECT register_id FROM pii_flagged)"
_SUBSET = f"subset AS (SELECT * FROM once WHERE register_id IS NULL OR register_id NOT IN {_FLAGGED})"
_FIRST_TITLE = "t AS (SELECT * FROM titles QUALIFY row_number() OVER (PARTITION BY id ORDER BY name NULLS FIRST, collection NULLS FIRST, year NULLS FIRST, number NULLS FIRST, status NULLS FIRST, isPrincipal NULLS FIRST, isInForce NULLS FIRST) = 1)"


def rollup(src: str) -> str:
    agg = f"count(DISTINCT register_id) AS titles, count(*) AS rows, count(*) FILTER (WHERE coalesce(section, '') <> '') AS section_rows, coalesce(sum({words('text')}), 0)::BIGINT AS words"
    return f"SELECT coalesce(collection, 'unknown') AS collection, {agg} FROM {src} GROUP BY 1 UNION ALL SELECT '*', {agg} FROM {src}"


def histogram(src: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {q(c)} AS dimension, coalesce({c}, 'unknown') AS value, count(*) AS n FROM {src} GROUP BY 2" for c in columns)


_SCANS = " UNION ALL ".join(
    f"SELECT *, {i} AS scan FROM t WHERE isInForce AND collection = {q(c)} AND contains(name, {q(k)})" for i, (c, k) in enumerate((c, k) for c in COLLECTIONS for k in KEYWORDS)
)
_LABEL = r"replace(coalesce(section, ''), '-', chr(8209))"
_WEIGHTED = " + ".join(f"{w} * substring(regexp_replace(value, '[ -]', '', 'g'), {i + 1}, 1)::INT" for i, w in enumerate(TFN_WEIGHTS))

ORACLE = {
    "word_counts": f"WITH {ONCE} SELECT register_id, count(*) AS rows, coalesce(sum({words('text')}), 0)::BIGINT AS words FROM once GROUP BY 1",
    "sentences": f"WITH {ONCE}, s AS (SELECT row_id, {SENTENCES} AS ss FROM once) SELECT row_id, unnest(range(len(ss))) AS pos, unnest(ss) AS sentence FROM s",
    "amounts": f"WITH {ONCE} SELECT row_id, {joined(money('text'))} AS money, {joined(percent('text'))} AS percent, {joined(factors('text'))} AS factors, {joined(years('text'))} AS years FROM once",
    "table_blocks": f"WITH {ONCE}, b AS (SELECT row_id, {BLOCKS} AS bs FROM once), u AS (SELECT row_id, unnest(range(len(bs))) AS pos, unnest(bs) AS block FROM b) SELECT *, len(string_split(block, chr(10))) AS n_lines FROM u",
    "phrases": f"WITH {ONCE}, h AS (SELECT *, {HAY} AS hay FROM once) SELECT row_id, {TOPIC} AS topic, {ownership('text')} AS ownership, {has('text', INDEX_PHRASE)} AS indexed, {fold('heading')} AS heading_ascii, left(replace(replace(text, '|', '\\|'), chr(10), ' '), 48) AS cell FROM h",
    "number_records": f"WITH {RECORDS} SELECT row_id, part, pos, kind, topic, {joined('amounts')} AS amounts, {joined('years')} AS years, {fold('content')} AS content_ascii, {fold('heading')} AS heading_ascii FROM records",
    "number_index": f"WITH {RECORDS} SELECT 'R' || lpad((row_number() OVER (ORDER BY topic, act NULLS FIRST, coalesce(section, ''), kind, row_id, part, pos))::VARCHAR, 5, '0') AS rate_id, row_id, part, pos, topic, kind FROM records",
    "number_histograms": f"WITH {RECORDS} {histogram('records', ['topic', 'kind', 'collection'])}",
    "top_per_topic": f"WITH {RECORDS}, k AS (SELECT topic, row_id, pos, row_number() OVER w AS rank, greatest(count(*) OVER (PARTITION BY topic) - 40, 0) AS remainder FROM records WHERE part = 0 WINDOW w AS (PARTITION BY topic ORDER BY act NULLS FIRST, coalesce(section, ''), row_id, pos)) SELECT * FROM k WHERE rank <= 40",
    "person_rows": f"WITH {ONCE} {persons('once', 3)}",
    "person_titles": f"WITH {ONCE}, hot AS ({persons('once', 3)}), tot AS (SELECT register_id, count(*) AS rows_total FROM once GROUP BY 1) SELECT register_id, any_value(rows_total) AS rows_total, count(*) AS rows_flagged, sum(names)::BIGINT AS names_est, sum(words)::BIGINT AS words FROM hot JOIN tot USING (register_id) GROUP BY 1",
    "sparse_person_rows": f"WITH {ONCE}, {_SUBSET} {persons('subset', 1)}",
    "check_digits": f"WITH {ONCE}, v AS (SELECT row_id, regexp_extract_all(text, '[0-9]{{3}}[ -]?[0-9]{{3}}[ -]?[0-9]{{3}}') AS vs FROM once), u AS (SELECT row_id, unnest(range(len(vs))) AS pos, unnest(vs) AS value FROM v) SELECT *, ({_WEIGHTED}) % 11 = 0 AS plausible FROM u",
    "pii_summary": "SELECT count(*) AS titles, (round_even(coalesce(sum(names_est), 0) / 50.0, 0) * 50)::BIGINT AS names FROM pii_flagged",
    "discover_titles": f"WITH {_FIRST_TITLE}, s AS ({_SCANS}) SELECT id, name, collection, isPrincipal, scan FROM s WHERE isPrincipal QUALIFY row_number() OVER (PARTITION BY id ORDER BY scan, name) = 1",
    "scan_counts": f"WITH {_FIRST_TITLE}, s AS ({_SCANS}), f AS (SELECT id, min(scan) AS first FROM s GROUP BY 1) SELECT n::INT AS scan, count(s.id) AS matched, count(*) FILTER (WHERE f.first = n) AS new FROM range({len(COLLECTIONS) * len(KEYWORDS)}) r(n) LEFT JOIN s ON s.scan = n LEFT JOIN f ON f.id = s.id GROUP BY 1",
    "keywords": f"WITH {_FIRST_TITLE} SELECT id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(coalesce(name, ''), '(?i)(^|[^A-Za-z]){k}') THEN {q(k)} END" for k in KEYWORDS) + "], lambda z: z IS NOT NULL), '|') AS keywords FROM t",
    "duplicate_titles": "SELECT id, count(*) AS n FROM titles GROUP BY 1 HAVING count(*) > 1",
    "latest_documents": "SELECT register_id, count(*) AS n_versions, max(retrieved) FILTER (WHERE epub IS NOT NULL) AS retrieved, max_by(epub, (retrieved, loaded_at, epub)) FILTER (WHERE epub IS NOT NULL) AS epub FROM sources GROUP BY 1",
    "merged_patches": f"WITH {_FIRST_TITLE} SELECT id, name, CASE WHEN id IN {_FLAGGED} THEN 'withheld' ELSE status END AS status, CASE WHEN id IN {_FLAGGED} THEN NULL ELSE number END AS number FROM t",
    "looked_up_names": f"WITH {_FIRST_TITLE} SELECT f.register_id, f.rows_flagged, coalesce(t.name, '?') AS title_name, t.collection AS title_collection FROM pii_flagged f LEFT JOIN t ON t.id = f.register_id",
    "inventory_diff": "SELECT coalesce(e, p) AS register_id, CASE WHEN p IS NULL THEN 'missing' WHEN e IS NULL THEN 'extra' ELSE 'both' END AS state FROM (SELECT DISTINCT id AS e FROM titles WHERE isInForce AND id IS NOT NULL) FULL JOIN (SELECT DISTINCT register_id AS p FROM sections WHERE register_id IS NOT NULL) ON e = p",
    "removed_lines": f"WITH {ONCE}, l AS (SELECT row_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM (SELECT row_id, string_split(text, chr(10)) AS ls FROM once)) SELECT row_id, pos, line FROM l WHERE NOT EXISTS (SELECT 1 FROM pii_flagged f WHERE f.name <> '' AND contains(l.line, f.name))",
    "contact_fingerprints": f"WITH {ONCE}, {contacts('once')} SELECT register_id, row_id, kind, sha256(value) AS sha256, count(*) AS n FROM contacts GROUP BY ALL",
    "section_labels": rf"""WITH {ONCE}, h AS (SELECT row_id, concat_ws(' ', CASE WHEN section IS NOT NULL THEN {_LABEL} END, coalesce(heading, '')) AS head FROM once),
x AS (SELECT row_id, regexp_extract(head, '([0-9]{{1,3}}[A-Z]{{0,4}})\s*\x{{2011}}\s*([0-9]{{1,4}}[A-Z]{{0,8}})', ['a', 'b']) AS d, regexp_extract(head, '^\s*([0-9]{{1,4}}[A-Z]{{0,8}})([.\s\x{{00A0}}\x{{2011}}]|$)', 1) AS p FROM h)
SELECT row_id, CASE WHEN d.a <> '' THEN d.a || '-' || d.b WHEN p <> '' THEN p END AS label FROM x""",
    "section_ordinals": f"WITH {ONCE} SELECT row_id, register_id || ':' || lpad((row_number() OVER (PARTITION BY register_id ORDER BY row_id))::VARCHAR, 4, '0') || ':' || CASE WHEN coalesce(section, '') = '' THEN '-' ELSE section END AS made FROM once",
    "volume_counts": """SELECT event_id, (count(*) FILTER (WHERE event_type = 'view') OVER w)::BIGINT AS volume, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS last_purchase,
lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "line_islands": f"""WITH {ONCE}, l AS (SELECT row_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM (SELECT row_id, string_split(text, chr(10)) AS ls FROM once)),
m AS (SELECT *, starts_with(line, '|') AS is_table, CASE WHEN lag(starts_with(line, '|')) OVER w IS NOT DISTINCT FROM starts_with(line, '|') THEN 0 ELSE 1 END AS fresh FROM l WINDOW w AS (PARTITION BY row_id ORDER BY pos)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY row_id ORDER BY pos) AS island FROM m),
r AS (SELECT row_id, island, bool_or(is_table) AS is_table, count(*) AS n_lines, max_by(line, pos) AS last_line FROM g GROUP BY 1, 2),
c AS (SELECT *, lag(CASE WHEN length(last_line) <= 80 THEN last_line END) OVER (PARTITION BY row_id ORDER BY island) AS caption FROM r)
SELECT row_id, island::BIGINT AS island, n_lines, caption, row_number() OVER (PARTITION BY row_id ORDER BY island) AS n, count(*) OVER (PARTITION BY row_id) AS total FROM c WHERE is_table""",
    "corpus_rollup": f"WITH {ONCE} {rollup('once')}",
    "kind_histogram": f"WITH {ONCE}, k AS (SELECT CASE WHEN coalesce(kind, '') <> '' THEN kind WHEN coalesce(section, '') <> '' THEN 'section' ELSE 'unnumbered' END AS kind, granularity FROM once) {histogram('k', ['kind', 'granularity'])}",
    "subset_rollup": f"WITH {ONCE}, {_SUBSET} {rollup('subset')}",
    "reconciliation": f"""WITH {ONCE}, last AS (SELECT register_id, max_by(jsonl_rows, (retrieved, loaded_at, jsonl_rows)) AS declared FROM sources GROUP BY 1), got AS (SELECT register_id, count(*) AS counted FROM once GROUP BY 1)
SELECT coalesce(last.register_id, got.register_id) AS register_id, declared, counted, declared IS NOT DISTINCT FROM counted AS agrees FROM last FULL JOIN got ON last.register_id = got.register_id""",
}
