"""Queries of lookups, gates, archives and tables read back, with their SQL."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from tabularium.functions import text as X
from tabularium.operators import blocks, relational, sequence
from tabularium.operators.numbers import _BASE, number_records
from tabularium.plans import corpus_sql as C
from tabularium.plans import pipeline_queries as P
from tabularium.plans import publication_queries as Q
from tabularium.plans.corpus_queries import sections
from tabularium.sources.tables import table

HISTORY = 60  # newest versions that a lookup of a title's history returns


def current_versions(spark, d):
    """Every title in force with the version that the last snapshot calls current, nulls where there is none."""
    t = relational.first_per_key(table(spark, d, "titles"), "id", ["name", "collection", "year", "number", "status", "isPrincipal", "isInForce"]).where("isInForce AND id IS NOT NULL").select("id", "name")
    v = Q._last(spark, d).where("version_is_current").select("register_id", "compilation_number", "compilation_date")
    return relational.lookup(t, "id", v, "register_id", ["compilation_number", "compilation_date"])


def version_history(spark, d):
    """The newest 60 rows of every title's history, newest first (the limit is the feature)."""
    h = Q._settled(spark, d).select("register_id", "retrieved", "compilation_number", "compilation_date")
    return sequence.ordinals(h, "register_id", [F.col("retrieved").desc()], "place").where(F.col("place") <= HISTORY)


def last_seen(spark, d):
    """Every title where it was seen first, as it was seen last."""
    return relational.last_value_first_place(Q._settled(spark, d), "register_id", "retrieved", ["name", "collection"])


def misnamed_documents(spark, d):
    """Declared files whose name is not that of their title."""
    t = Q._last(spark, d)
    return t.where(F.col("epub").isNotNull() & (F.regexp_extract("epub", r"([^/]*)$", 1) != F.concat("register_id", F.lit(".epub")))).select("register_id", "epub")


def extension_histogram(spark, d):
    """Declared files by extension."""
    paths = Q._last(spark, d).select(F.explode(F.array_compact(F.array("epub", "markdown", "sections_jsonl", "endnotes"))).alias("path"))
    return paths.groupBy(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("extension")).agg(F.count("*").alias("n"))


def subset_numbers(spark, d):
    """Number records of titles that are not flagged, by title."""
    kept = number_records(Q._rows(spark, d, [*_BASE, "text"]))
    return kept.groupBy("register_id").agg(F.count("*").alias("n"))


def subset_not_current(spark, d):
    """Titles not flagged whose compilation is not the version in force."""
    return Q._kept(spark, d, Q._last(spark, d)).where("version_is_current = false").select("register_id", "name", "current_version_start")


def diagnostics(spark, d):
    """Every text as one printable line for a log."""
    return sections(spark, d, ["text"]).select("row_id", X.diagnostic(F.col("text")).alias("line"))


def _zipped(batches):
    for b in batches:
        out = []
        for html in b.column(1).to_pylist():
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("OEBPS/document_1/document_1.xhtml", html)
                z.writestr("mimetype", "application/epub+zip")
            out.append(held.getvalue())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["row_id", "content"])


def archive_scan(spark, d):
    """Every document as a zip archive, tested and read back: its blocks are those of the document."""
    packed = P._documents(spark, d).select("row_id", "html").mapInArrow(_zipped, "row_id string, content binary")
    good = blocks.valid_archives(packed, "content").where("valid")
    b = blocks.exploded(blocks.read_archives(good, "row_id", "content"), "row_id")
    chars = F.coalesce(F.sum(F.when(F.col("k") == "p", F.char_length("text"))), F.lit(0))
    return b.groupBy("row_id").agg(F.count("*").alias("blocks"), F.count_if(F.col("k") == "p").alias("paragraphs"), chars.alias("chars"))


def table_round_trip(spark, d):
    """Every table of the texts as an XHTML table with nested markup, read back into cells."""
    s = sections(spark, d, ["text"])
    t = s.select("row_id", F.posexplode(X.table_blocks(F.col("text"))).alias("pos", "block"))
    lines = F.filter(X.lines(F.col("block")), lambda x: ~x.rlike(r"\A\|[-|: ]*\z"))
    cells = lambda x: F.split(F.regexp_replace(x, r"\A\||\|\s*\z", ""), r"\|")
    cell = lambda c: F.concat(F.lit('<td><p class="Tabletext">'), P._escaped(c), F.lit("</p></td>"))
    rows = F.transform(lines, lambda x: F.concat(F.lit("<tr>"), F.array_join(F.transform(cells(x), cell), ""), F.lit("</tr>")))
    html = F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>"))
    read = blocks.exploded(blocks.read_html(t.select(F.struct("row_id", "pos").alias("key"), html.alias("html")), "key", "html"), "key").where("k = 'table'")
    return read.select("key.row_id", "key.pos", F.size("rows").alias("n_rows"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "¦")), "\n").alias("cells"))


QUERIES = {
    f.__name__: f
    for f in (
        current_versions, version_history, last_seen, misnamed_documents, extension_histogram, subset_numbers, subset_not_current, diagnostics, archive_scan, table_round_trip,
    )
}

_LINES = "list_filter(string_split(block, chr(10)), lambda z: NOT regexp_full_match(z, '\\|[-|: ]*'))"
_TRIM = lambda e: f"regexp_replace(regexp_replace({e}, '^{P._WS}+', ''), '{P._WS}+$', '')"
_CELL = f"""{_TRIM("regexp_replace(replace(c, chr(160), ' '), '[ \\t]+', ' ', 'g')")}"""
_ROW = f"list_transform(string_split(regexp_replace(regexp_replace(z, '^\\|', ''), '\\|\\s*$', ''), '|'), lambda c: {_CELL})"
_TITLES = "t AS (SELECT * FROM titles QUALIFY row_number() OVER (PARTITION BY id ORDER BY name NULLS FIRST, collection NULLS FIRST, year NULLS FIRST, number NULLS FIRST, status NULLS FIRST, isPrincipal NULLS FIRST, isInForce NULLS FIRST) = 1)"

ORACLE = {
    "current_versions": f"WITH {_TITLES}, {Q._LAST} SELECT id, t.name, compilation_number, compilation_date FROM t LEFT JOIN last ON register_id = id AND version_is_current WHERE isInForce AND id IS NOT NULL",
    "version_history": f"WITH {Q._SETTLED} SELECT register_id, retrieved, n AS compilation_number, cd AS compilation_date, row_number() OVER (PARTITION BY register_id ORDER BY retrieved DESC) AS place FROM s QUALIFY place <= 60",
    "last_seen": f"WITH {Q._SETTLED} SELECT register_id, min(retrieved) AS retrieved, max_by(name, i) AS name, max_by(collection, i) AS collection FROM s GROUP BY 1",
    "misnamed_documents": f"WITH {Q._LAST} SELECT register_id, epub FROM last WHERE regexp_extract(epub, '([^/]*)$', 1) <> register_id || '.epub'",
    "extension_histogram": f"WITH {Q._LAST}, p AS (SELECT unnest([epub, markdown, sections_jsonl, endnotes]) AS path FROM last) SELECT lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS extension, count(*) AS n FROM p WHERE path IS NOT NULL GROUP BY 1",
    "subset_numbers": f"WITH {C.RECORDS} SELECT register_id, count(*) AS n FROM records JOIN once USING (row_id) WHERE register_id NOT IN (SELECT register_id FROM pii_flagged) GROUP BY 1",
    "subset_not_current": f"WITH {Q._LAST} SELECT register_id, name, current_version_start FROM last WHERE version_is_current = false AND register_id NOT IN (SELECT register_id FROM pii_flagged)",
    "diagnostics": f"WITH {C.ONCE}, f AS (SELECT row_id, trim(regexp_replace(regexp_replace(text, '[^\\x20-\\x7E\\x{{A1}}-\\x{{10FFFF}}]', ' ', 'g'), ' {{2,}}', ' ', 'g')) AS flat FROM once) SELECT row_id, CASE WHEN coalesce(flat, '') = '' THEN '?' ELSE left(flat, 80) END AS line FROM f",
    "archive_scan": P.ORACLE["block_scan"].replace(f"{P._HEAD} AS headings, ", ""),
    "table_round_trip": f"""WITH {C.ONCE}, b AS (SELECT row_id, {C.BLOCKS} AS bs FROM once), u AS (SELECT row_id, unnest(range(len(bs))) AS pos, unnest(bs) AS block FROM b),
r AS (SELECT row_id, pos, list_filter(list_transform({_LINES}, lambda z: {_ROW}), lambda r: len(list_filter(r, lambda c: c <> '')) > 0) AS rows FROM u)
SELECT row_id, pos, len(rows) AS n_rows, array_to_string(list_transform(rows, lambda r: array_to_string(r, '¦')), chr(10)) AS cells FROM r WHERE len(rows) > 0""",
}
