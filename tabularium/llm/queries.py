"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.leakage import leaks
from tabularium.llm.lookalikes import REPORTED, normalise, not_ascii
from tabularium.llm.mixing import mix, report, token_counts
from tabularium.llm.neardup import classes, expand, similar
from tabularium.llm.personal import find_personal, redact_personal
from tabularium.llm.repetition import repetition
from tabularium.llm.splitting import LIMIT, OVERLAP, split_long, split_oversized
from tabularium.sources.tables import once_per_key, spread, table


def _sections(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    return spread(table(spark, d, "sections").select("row_id", "loaded_at", *columns))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Texts over the limit, with the coarsest boundary whose stretches all fit."""
    # a row delivered again has the same text, so repeats are dropped from the small result
    return split_long(_sections(spark, d, ["text"]), "text", ["row_id"]).where("piece = 0").select("row_id", "boundary").distinct()


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every text as pieces within the limit, each with its row_id and section."""
    once = once_per_key(_sections(spark, d, ["section", "text"]), "row_id", ["section", "text"], "loaded_at", wide=True)
    return split_oversized(once, "text", ["row_id", "section"])


def p1_checks(spark: SparkSession, d: str) -> DataFrame:
    """Of every row_id whether its pieces keep the limit and the overlap, and the SHA-256 of the text they make when joined."""
    p = p1_pieces(spark, d).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("piece", "start", "end", "piece_text"))).alias("p"))
    fits = F.forall("p", lambda x: (F.char_length(x["piece_text"]) <= LIMIT) & (x["end"] - x["start"] == F.char_length(x["piece_text"])))
    steps = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(1))), lambda a, b: b.isNull() | (a["end"] - b["start"] == OVERLAP))
    parts = F.transform("p", lambda x: F.when(x["piece"] == 0, x["piece_text"]).otherwise(F.substring(x["piece_text"], F.lit(OVERLAP + 1), F.char_length(x["piece_text"]))))
    return p.select("row_id", (fits & F.forall(steps, lambda x: x)).alias("fits"), F.sha2(F.array_join(parts, ""), 256).alias("sha256"))


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every text with typed placeholders in the place of personal information."""
    once = once_per_key(_sections(spark, d, ["text"]), "row_id", ["text"], "loaded_at", wide=True)
    return redact_personal(once, "row_id", "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct item per row_id, as written."""
    found = find_personal(spread(table(spark, d, "sections").select("row_id", "text")), "row_id", "text")
    # cards and accounts are found and redacted too, but are no kinds of this query
    return found.where(~F.col("kind").isin("card", "iban")).select("row_id", "kind", "value").distinct()


def p3_normalised(spark: SparkSession, d: str) -> DataFrame:
    """section and text of every row_id in one consistent form."""
    once = once_per_key(_sections(spark, d, ["section", "text"]), "row_id", ["section", "text"], "loaded_at", wide=True)
    return normalise(once, "row_id", {"section": True, "text": False}).select("row_id", "section", "text")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Fields whose value held characters that only look like others."""
    odd = table(spark, d, "sections").where(not_ascii("section", "text"))
    done = normalise(odd, "row_id", {"section": True, "text": False})
    reported = F.array(*[F.lit(c) for c in REPORTED])
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.arrays_overlap(f"{f}_found", reported).alias("hit")) for f in ("section", "text")])
    return done.select("row_id", F.inline(fields)).where("hit").select("row_id", "field").distinct()


def _similar(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return similar(spread(table(spark, d, "sections").select("row_id", "text")), "row_id", "text", shingle=3, threshold=(3, 5), least_words=40)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of row_ids whose texts are nearly the same."""
    return expand(*_similar(spark, d), "row_id")


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """The class of every row_id and its number of links to other classes of equal texts."""
    return classes(*_similar(spark, d), "row_id")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items by document, verbatim or covered by reordered passages."""
    return _leaks(spark, d)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).where("verbatim").select("item_id", "doc_id")


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(spread(table(spark, d, "documents").select("doc_id", "source", "text")), "doc_id", "source", "text")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mix: which document stands where, in which repetition."""
    return mix(_counts(spark, d), table(spark, d, "mix_targets"))[0].withColumnRenamed("doc", "doc_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source of the mix."""
    return report(*mix(_counts(spark, d), table(spark, d, "mix_targets")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose draws from the schedule do not make up their share."""
    return p8_report(spark, d).where("NOT reaches").select("source")


#: The trusted target of p9: the register's own texts.
TRUSTED_SOURCE = "register_text"


def _repetition(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text", "source"))
    return repetition(docs, "doc_id", "text", F.col("source") == TRUSTED_SOURCE)


def p9_repetition(spark: SparkSession, d: str) -> DataFrame:
    """Share of repeated content of every document."""
    return _repetition(spark, d).select("doc_id", "n_words", "repeated_words", "repeated_share")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    """Log-likelihood ratio of every document and whether it reaches the threshold."""
    return _repetition(spark, d).select("doc_id", "score", "repetitive")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose ratio reaches the threshold and that have three tenths of their words or more in repeated passages."""
    return _repetition(spark, d).where("repetitive AND repeated_words * 10 >= n_words * 3").select("doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_pieces": p1_pieces,
    "p1_checks": p1_checks,
    "p2_found": p2_found,
    "p2_redacted": p2_redacted,
    "p3_found": p3_found,
    "p3_normalised": p3_normalised,
    "p4_found": p4_found,
    "p4_groups": p4_groups,
    "p7_found": p7_found,
    "p7_leaks": p7_leaks,
    "p8_found": p8_found,
    "p8_mix": p8_mix,
    "p8_report": p8_report,
    "p9_found": p9_found,
    "p9_repetition": p9_repetition,
    "p9_scores": p9_scores,
}

_ONCE = "once AS (SELECT * FROM sections WHERE row_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
_WORDS = "regexp_extract_all(lower(text), '[a-z0-9]+')"
_LOOKS = (
    r"[\x{FF01}-\x{FF5E}\x{FFE0}-\x{FFE6}\p{M}\x{00AD}\x{180E}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}"
    r"\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{2011}\x{FB00}-\x{FB06}\x{1D400}-\x{1D7FF}]"
)
_MIXED = r"\p{Latin}[\p{L}\p{M}\p{N}]*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}][\p{L}\p{M}\p{N}]*\p{Latin}"


_STYLED = "".join(chr(k) for k in range(0x1D400, 0x1D800) if unicodedata.normalize("NFKC", chr(k)) != chr(k))
_WIDE = "".join(chr(k) for k in range(0xFF01, 0xFF5F))
_FROM = _STYLED + _WIDE + "".join(map(chr, [0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000, 0x2011]))
_TO = unicodedata.normalize("NFKC", _STYLED + _WIDE) + " " * 16 + "-"
_LIGATURES = [(chr(k), unicodedata.normalize("NFKC", chr(k))) for k in range(0xFB00, 0xFB07)]
# Greek and Cyrillic letters and the Latin letters they look like, as far as the tables hold them.
_ALIKE = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχγАВЕКМНОРСТУХЅІЈаеорсухѕіјһԁкмтвн", "ABEZHIKMNOPTYXaikvopuxyABEKMHOPCTYXSIJaeopcyxsijhdkmtbh")


def _form(c: str) -> str:
    """A text's consistent form but for look-alike letters."""
    quote = "''"
    e = f"translate({c}, '{_FROM}', '{_TO.replace(quote[0], quote)}')"
    for a, b in _LIGATURES:
        e = f"replace({e}, '{a}', '{b}')"
    return f"nfc_normalize(regexp_replace({e}, '[\\x{{00AD}}\\x{{180E}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}-\\x{{2064}}\\x{{FEFF}}]', '', 'g'))"


def _latin(w: str) -> str:
    return f"translate({w}, '{_ALIKE[0]}', '{_ALIKE[1]}')"


def _mixed_words(c: str) -> str:
    """Look-alike letters in words that also have Latin letters."""
    parts = f"regexp_extract_all({c}, '[\\p{{L}}\\p{{M}}\\p{{N}}]+|[^\\p{{L}}\\p{{M}}\\p{{N}}]+')"
    return f"CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform({parts}, lambda w: CASE WHEN regexp_matches(w, '\\p{{Latin}}') AND regexp_matches(w, '[\\p{{Greek}}\\p{{Cyrillic}}]') THEN {_latin('w')} ELSE w END), '') END"


def _grams(n: int) -> str:
    return f"list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))"


ORACLE = {
    "p1_found": r"""
SELECT DISTINCT row_id,
  CASE WHEN list_max(list_transform(regexp_split_to_array(text, '\r?\n(?:[ \t]*\r?\n)+'), lambda x: length(x))) <= 3000 THEN 'paragraph'
       WHEN list_max(list_transform(regexp_split_to_array(text, '[\r\n]+'), lambda x: length(x))) <= 3000 THEN 'line'
       WHEN list_max(list_transform(string_split(regexp_replace(regexp_replace(text, '([.;:?])\s+', '\1' || chr(1), 'g'), '[\r\n]+', chr(1), 'g'), chr(1)), lambda x: length(x))) <= 3000 THEN 'sentence'
       ELSE 'none' END AS boundary
FROM sections WHERE length(text) > 3000""",
    "p1_checks": f"WITH {_ONCE} SELECT row_id, true AS fits, sha256(text) AS sha256 FROM once WHERE text IS NOT NULL",
    "p3_normalised": f"WITH {_ONCE}, f AS (SELECT row_id, {_latin(_form('section'))} AS section, {_form('text')} AS text FROM once) SELECT row_id, trim(section) AS section, {_mixed_words('text')} AS text FROM f",
    "p3_found": f"""
SELECT DISTINCT row_id, 'section' AS field FROM sections WHERE regexp_matches(section, '{_LOOKS}') OR regexp_matches(section, '[\\p{{Greek}}\\p{{Cyrillic}}]')
UNION ALL
SELECT DISTINCT row_id, 'text' FROM sections WHERE regexp_matches(text, '{_LOOKS}') OR regexp_matches(text, '{_MIXED}')""",
    "p4_found": f"""
WITH {_ONCE}, wd AS (SELECT row_id, {_WORDS} AS w FROM once),
sh AS (SELECT row_id, list_distinct({_grams(3)}) AS s FROM wd WHERE len(w) >= 40),
t AS (SELECT row_id, len(s) AS n, unnest(s) AS g FROM sh),
c AS (SELECT a.row_id AS x, b.row_id AS y, a.n AS nx, b.n AS ny, count(*) AS k FROM t a JOIN t b ON a.g = b.g AND a.row_id < b.row_id GROUP BY ALL)
SELECT x AS row_id_a, y AS row_id_b FROM c WHERE k * 5 >= (nx + ny - k) * 3""",
    "p4_groups": f"""
WITH RECURSIVE {_ONCE}, wd AS (SELECT row_id, {_WORDS} AS w FROM once),
sh AS (SELECT row_id, list_sort(list_distinct({_grams(3)})) AS s FROM wd WHERE len(w) >= 40),
k AS (SELECT row_id, min(row_id) OVER (PARTITION BY s) AS rep, s FROM sh),
t AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM (SELECT DISTINCT rep, s FROM k)),
e AS (SELECT a.rep AS x, b.rep AS y FROM t a JOIN t b ON a.g = b.g AND a.rep <> b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING count(*) * 5 >= (a.n + b.n - count(*)) * 3),
r AS (SELECT DISTINCT rep AS v, rep AS u FROM k UNION SELECT r.v, e.y FROM r JOIN e ON e.x = r.u),
c AS (SELECT v, min(u) AS class_id FROM r GROUP BY 1), d AS (SELECT x, count(*) AS links FROM e GROUP BY 1)
SELECT row_id, class_id, coalesce(links, 0) AS links FROM k JOIN c ON c.v = k.rep LEFT JOIN d ON d.x = k.rep""",
    "p7_found": f"""
WITH iw AS (SELECT item_id, {_WORDS} AS w FROM eval_items), dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
ig AS (SELECT item_id, least(15, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(15, len(w)) + 2), lambda i: array_to_string(w[i:i + least(15, len(w)) - 1], ' '))) AS g FROM iw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM ig),
dg AS (SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM dw, sizes WHERE len(w) >= n)
SELECT DISTINCT item_id, doc_id FROM dg JOIN ig USING (n, g)""",
    "p9_repetition": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents), n AS (SELECT doc_id, coalesce(len(w), 0) AS n_words FROM dw),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest({_grams(8)}) AS g FROM dw WHERE len(w) >= 8),
again AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY doc_id, g ORDER BY i) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(8) r(k) GROUP BY 1)
SELECT doc_id, n_words, coalesce(n, 0) AS repeated_words, CASE WHEN n_words > 0 THEN coalesce(n, 0) / n_words ELSE 0.0 END AS repeated_share FROM n LEFT JOIN covered USING (doc_id)""",
    "p9_found": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, len(w) AS words, unnest(range(1, len(w) - 6)) AS i, unnest({_grams(8)}) AS g FROM dw WHERE len(w) >= 8),
again AS (SELECT doc_id, words, i FROM g QUALIFY row_number() OVER (PARTITION BY doc_id, g ORDER BY i) > 1),
covered AS (SELECT doc_id, words, count(DISTINCT i + k) AS n FROM again, range(8) r(k) GROUP BY 1, 2)
SELECT doc_id FROM covered WHERE n * 10 >= words * 3""",
}
