"""Queries of publication: counts, indexes, provenance, reports and the checks of a version, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.operators import privacy, publication, relational, rollup, verify
from tabularium.operators.numbers import _BASE, number_index, number_records
from tabularium.plans import corpus_sql as C
from tabularium.plans.corpus_queries import sections
from tabularium.session import materialise
from tabularium.sources.tables import table

_LISTED = [
    "name", "collection", "keywords_in_name", "long_title", "compilation_number", "compilation_date", "version_is_current", "current_version_start", "retrieved",
    "jsonl_rows", "granularity", "words", "epub", "markdown", "sections_jsonl", "endnotes", "source_url", "register_page",
]


def _last(spark, d) -> DataFrame:
    """The title list as last delivered: per title the latest row of its latest snapshot."""
    s = table(spark, d, "sources")
    row = F.struct("retrieved", "loaded_at", *[c for c in _LISTED if c != "retrieved"])
    return s.groupBy("register_id").agg(F.max(row).alias("r")).select("register_id", *[F.col(f"r.{c}").alias(c) for c in _LISTED])


def _kept(spark, d, df: DataFrame) -> DataFrame:
    return relational.without(df, "register_id", table(spark, d, "pii_flagged"), "register_id")


def _rows(spark, d, columns: list[str]) -> DataFrame:
    return _kept(spark, d, sections(spark, d, columns))


_FACTS = ["register_id", "collection", "section", "kind", "text"]  # row_id comes with them


def counts_block(spark, d):
    """The counts of the subset without flagged titles, recounted from its rows."""
    titles = _kept(spark, d, _last(spark, d))
    return publication.counts_block(titles, _rows(spark, d, _FACTS), titles.where("epub IS NULL"))


def index_lines(spark, d):
    """The index of all titles, one line each, behind the totals of every collection."""
    per = rollup.per_title(sections(spark, d, ["register_id", "section", "text"]))
    return publication.index_lines(_last(spark, d), per)


def provenance_blocks(spark, d):
    """The provenance of every title's document and of its end notes."""
    t = _last(spark, d).withColumn("markdown", F.concat(F.lit("# "), "name")).withColumn("endnotes_text", F.when(F.col("endnotes").isNotNull(), F.col("long_title")))
    return publication.title_documents(t)


def removed_titles(spark, d):
    """The list of titles left out, most names first."""
    return publication.removed_lines(table(spark, d, "pii_flagged"))


def number_lines(spark, d):
    """The readable index of numbers (its limits of 40 tables and 120 provisions a topic are the feature)."""
    columns = ["register_id", "act", "collection", "section", "heading", "topic", "kind", "amounts", "content"]
    indexed = number_index(sections(spark, d, [*_BASE, "text"]), columns)
    return publication.number_lines(indexed.withColumn("_at", F.substring("rate_id", 2, 20).cast("bigint")), "_at")


def contact_report(spark, d):
    """By kind: contacts, those not approved, and how many different ones and titles; the allowlist holds the contacts that several titles share."""
    c = privacy.contact_fingerprints(sections(spark, d, ["register_id", "text"]), ["register_id", "row_id"], "text")
    return privacy.contact_report(c, _approved(c))


def contact_examples(spark, d):
    """Up to five contacts of every kind that are not approved, by row and 16 digits of their fingerprint (the limit is the feature)."""
    c = privacy.contact_fingerprints(sections(spark, d, ["register_id", "text"]), ["register_id", "row_id"], "text")
    return privacy.contact_examples(c, _approved(c))


def _approved(contacts: DataFrame) -> DataFrame:
    """Contacts that two titles or more have in common: those of offices, not of persons."""
    shared = contacts.where("kind <> 'tfn'").groupBy("kind", "sha256").agg(F.count_distinct("register_id").alias("n")).where("n > 1").select("kind", "sha256")
    return contacts.join(shared, ["kind", "sha256"]).select("kind", "sha256", "register_id").distinct()


def flagged_totals(spark, d):
    """Totals of the flagged titles: titles, rows, names and words."""
    f = table(spark, d, "pii_flagged")
    sums = ["rows_total", "rows_flagged", "names_est", "words"]
    return f.agg(F.count("*").alias("titles"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def document_statuses(spark, d):
    """Per title in force what became of its document in the last snapshot, and how many words it has."""
    t = relational.first_per_key(table(spark, d, "titles"), "id", ["name", "collection", "year", "number", "status", "isPrincipal", "isInForce"]).where("isInForce AND id IS NOT NULL")
    return relational.document_statuses(t.select(F.col("id").alias("register_id")), _settled(spark, d), "register_id", "retrieved", "endnotes", ["compilation_number", "compilation_date"], "words")


def download_tallies(spark, d):
    """Documents and words by status."""
    return document_statuses(spark, d).groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))


def recoverable_documents(spark, d):
    """Titles whose last snapshot has no end notes although an earlier one had them: the one to fetch again."""
    return relational.recoverable(_settled(spark, d), "register_id", "retrieved", "endnotes")


def _settled(spark, d) -> DataFrame:
    from tabularium.operators.snapshots import numeric_text, settle

    s = table(spark, d, "sources").withColumn("compilation_number", numeric_text(F.col("compilation_number")).cast("bigint"))
    return settle(s, "register_id", "retrieved", "loaded_at", ["collection", "name", "compilation_number", "compilation_date", "epub", "endnotes", "words"])


def lookup_states(spark, d):
    """Every snapshot against the one before: what a check of each title would have reported."""
    return relational.lookup_states(
        _settled(spark, d), table(spark, d, "titles").select("id"), "register_id", "id", "retrieved", ["compilation_number", "compilation_date"], "name", "endnotes"
    )


def staleness_counts(spark, d):
    """How many titles every check reported in each state."""
    return lookup_states(spark, d).groupBy("retrieved", "state").agg(F.count("*").alias("n"))


def published(spark, d) -> verify.Published:
    """The subset without flagged titles as it would be published: its row counts as announced in the title list."""
    titles = _kept(spark, d, _last(spark, d)).withColumn("epub", F.lit(None).cast("string"))
    rows = _rows(spark, d, _FACTS)
    announced = {"jsonl_rows": "jsonl_rows", "words_body_only": "words"}
    said = titles.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in announced.items()])
    said = said.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("bigint").alias("value")) for n in announced])))
    counts = publication.counts_block(titles, rows, titles.where("markdown IS NULL"))
    # both are used by many checks: written once
    counts = materialise(counts.where(~F.col("name").isin(list(announced))).unionByName(said))
    numbers = materialise(number_records(_rows(spark, d, [*_BASE, "text"])).select("register_id", "kind", "content"))
    removed = table(spark, d, "pii_flagged").select("register_id", "name", "names_est", "rows_total")
    folders = rows.select("register_id").distinct()
    files = folders.select(F.inline(F.array(*[F.struct(F.format_string(p, "register_id").alias("path"), F.lit(k).alias("kind"), F.lit(0).cast("bigint").alias("bytes")) for p, k in (("markdown/%s", "dir"), ("markdown/%1$s/%1$s.md", "file"), ("markdown/%s/sections.jsonl", "file"))])))
    notes = titles.where("endnotes IS NOT NULL").select(F.format_string("markdown/%s/endnotes.md", "register_id").alias("path"), F.lit("file").alias("kind"), F.lit(0).cast("bigint").alias("bytes"))
    value = lambda n: F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0))
    readme = counts.agg(F.format_string("%d Acts and %d legislative and notifiable instruments: %d in-force principal titles.", value("acts"), value("instruments"), value("titles")).alias("line"))
    at = lambda path, df: df.select(F.lit(path).alias("path"), "line")
    lines = [
        at("INDEX.md", publication.index_headline(counts)),
        at("INDEX.md", publication.index_lines(titles, materialise(rollup.per_title(rows)))),
        at("README.md", readme),
        at("README.md", publication.index_headline(counts)),
        at("REMOVED.md", publication.removed_lines(removed)),
        at("rates/RATES.md", numbers.agg(F.format_string(publication.NUMBERS_HEADLINE, publication.thousands(F.count("*")), publication.thousands(F.countDistinct("register_id"))).alias("line"))),
        at("rates/RATES.md", numbers.select(F.col("content").alias("line"))),
    ]
    allow = spark.createDataFrame([], "kind string, sha256 string, register_id string")
    return verify.Published(titles, rows, numbers, removed, allow, counts, reduce(DataFrame.unionByName, lines), files.unionByName(notes))


def subset_checks(spark, d):
    """All checks of the subset without flagged titles."""
    return verify.checks(published(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        counts_block, index_lines, provenance_blocks, removed_titles, number_lines, contact_report, contact_examples, flagged_totals, document_statuses, download_tallies,
        recoverable_documents, lookup_states, staleness_counts, subset_checks,
    )
}

_LAST = "last AS (SELECT * FROM sources QUALIFY row_number() OVER (PARTITION BY register_id ORDER BY retrieved DESC, loaded_at DESC) = 1)"
_DROP = "(SELECT register_id FROM pii_flagged)"
_KEPT = f"{C.ONCE}, {_LAST}, kept AS (SELECT * FROM last WHERE register_id NOT IN {_DROP}), sub AS (SELECT * FROM once WHERE register_id IS NULL OR register_id NOT IN {_DROP})"
_N = "format('{:,}', %s)"
_WORDS = C.words("text")
_KIND = "CASE WHEN coalesce(kind, '') <> '' THEN kind WHEN coalesce(section, '') <> '' THEN 'section' ELSE 'unnumbered' END"
_COLL = "coalesce(nullif(sub.collection, ''), nullif(kept.collection, ''), 'unknown')"
_COUNTS = f"""
tc AS (SELECT count(*) AS titles, count(*) FILTER (WHERE collection = 'Act') AS acts, count(*) FILTER (WHERE collection IS DISTINCT FROM 'Act') AS instruments,
  count(*) FILTER (WHERE coalesce(len(keywords_in_name), 0) = 0) AS titles_no_keyword_in_current_name, count(*) FILTER (WHERE granularity = 'whole_act') AS titles_whole_act_chunk,
  count(*) FILTER (WHERE granularity = 'table_block') AS titles_table_block_chunk, count(*) FILTER (WHERE coalesce(endnotes, '') <> '') AS titles_with_endnotes,
  count(*) FILTER (WHERE version_is_current = false) AS titles_not_current_version, count(*) FILTER (WHERE epub IS NULL) AS titles_without_epub, 0::BIGINT AS epub_bytes FROM kept),
rc AS (SELECT count(*) AS jsonl_rows, coalesce(sum({_WORDS}), 0)::BIGINT AS words_body_only, count(*) FILTER (WHERE coalesce(section, '') <> '') AS rows_with_section_id,
  count(*) FILTER (WHERE {_KIND} = 'container') AS rows_container, count(*) FILTER (WHERE {_KIND} = 'unnumbered') AS rows_unnumbered,
  count(*) FILTER (WHERE {_KIND} = 'introductory') AS rows_introductory FROM sub),
bt AS (SELECT coalesce(collection, 'unknown') AS c, count(*) AS titles FROM kept GROUP BY 1),
br AS (SELECT {_COLL} AS c, count(*) AS rows, coalesce(sum({C.words('sub.text')}), 0)::BIGINT AS words FROM sub LEFT JOIN kept USING (register_id) GROUP BY 1),
bc AS (SELECT c, titles, coalesce(rows, 0) AS rows, coalesce(words, 0) AS words FROM bt LEFT JOIN br USING (c)),
counts AS (SELECT name, value FROM (UNPIVOT tc ON COLUMNS(*) INTO NAME name VALUE value) UNION ALL SELECT name, value FROM (UNPIVOT rc ON COLUMNS(*) INTO NAME name VALUE value)
  UNION ALL SELECT 'by_collection.' || c || '.' || k, v FROM (UNPIVOT bc ON titles, rows, words INTO NAME k VALUE v))"""
_PLACE = "CASE collection WHEN 'Act' THEN 1 WHEN 'LegislativeInstrument' THEN 2 WHEN 'NotifiableInstrument' THEN 3 ELSE 4 END"
_LABEL = "CASE collection WHEN 'Act' THEN 'Acts' WHEN 'LegislativeInstrument' THEN 'Legislative instruments' WHEN 'NotifiableInstrument' THEN 'Notifiable instruments' ELSE 'Other collections' END"
_ATTRIBUTION = C.q(publication.ATTRIBUTION.split("%s")[0]) + " || strftime(retrieved, '%Y-%m-%d') || " + C.q(publication.ATTRIBUTION.split("%s")[1])


def _block(notes: bool) -> str:
    """A provenance block, said in SQL."""
    name = "'Endnotes: ' || name" if notes else "name"
    out = [("register_id", "register_id"), ("title", f"to_json({name})::VARCHAR")]
    out += [] if notes else [("long_title", "to_json(coalesce(long_title, ''))::VARCHAR")]
    out += [(c, f"coalesce(nullif({c}, ''), 'null')") for c in ("collection", "compilation_number")] + [("compilation_date", "coalesce(strftime(compilation_date, '%Y-%m-%d'), 'None')")]
    if not notes:
        out += [("version_is_current", "CASE WHEN version_is_current = false THEN 'false' ELSE 'true' END"), ("superseded_from", "coalesce(strftime(current_version_start, '%Y-%m-%d'), 'null')")]
    out += [(c, f"coalesce({c}, '')") for c in ("source_url", "register_page")] + [("retrieved", "strftime(retrieved, '%Y-%m-%d')"), ("licence", "'CC BY 4.0'"), ("licence_url", "'https://creativecommons.org/licenses/by/4.0/'")]
    out += [("authorised", "'false'"), ("attribution", f"to_json({_ATTRIBUTION})::VARCHAR")]
    return "'---' || chr(10) || " + " || ".join(f"'{k}: ' || {v} || chr(10)" for k, v in out) + " || '---' || chr(10)"


_SETTLED = """st AS (SELECT register_id, retrieved, collection, name, TRY_CAST(nullif(regexp_extract(compilation_number, '(\\d+)', 1), '') AS BIGINT) AS n, compilation_date AS cd, epub, endnotes, words FROM sources
 WHERE register_id IS NOT NULL AND retrieved IS NOT NULL QUALIFY row_number() OVER (PARTITION BY register_id, retrieved ORDER BY loaded_at DESC NULLS LAST) = 1),
cal AS (SELECT retrieved, row_number() OVER (ORDER BY retrieved) AS i FROM (SELECT DISTINCT retrieved FROM st)), s AS (SELECT * FROM st JOIN cal USING (retrieved))"""
_STATES = f"""{_SETTLED}, states AS (SELECT a.register_id, c.retrieved, CASE
  WHEN b.register_id IS NULL AND a.register_id NOT IN (SELECT id FROM titles WHERE id IS NOT NULL) THEN 'error' WHEN b.register_id IS NULL THEN 'gone'
  WHEN b.n IS NULL AND b.cd IS NULL THEN 'error' WHEN lower(trim(a.name)) IS DISTINCT FROM lower(trim(b.name)) THEN 'error'
  WHEN a.n IS NOT DISTINCT FROM b.n AND a.cd IS NOT DISTINCT FROM b.cd THEN 'unchanged' WHEN b.endnotes IS NULL THEN 'no-document' ELSE 'superseded' END AS state
 FROM s a JOIN cal c ON c.i = a.i + 1 LEFT JOIN s b ON b.register_id = a.register_id AND b.i = a.i + 1)"""
_STATUS = f"""{_SETTLED}, t AS (SELECT DISTINCT id FROM (SELECT * FROM titles QUALIFY row_number() OVER (PARTITION BY id ORDER BY name NULLS FIRST, collection NULLS FIRST, year NULLS FIRST, number NULLS FIRST, status NULLS FIRST, isPrincipal NULLS FIRST, isInForce NULLS FIRST) = 1) WHERE isInForce AND id IS NOT NULL),
m AS (SELECT max(i) AS i FROM cal), status AS (SELECT t.id AS register_id, CASE WHEN b.register_id IS NULL THEN 'error' WHEN b.endnotes IS NULL THEN 'no_epub'
  WHEN a.endnotes IS NOT DISTINCT FROM b.endnotes AND a.n IS NOT DISTINCT FROM b.n AND a.cd IS NOT DISTINCT FROM b.cd THEN 'cached' ELSE 'ok' END AS status, b.words AS words
 FROM t CROSS JOIN m LEFT JOIN s b ON b.register_id = t.id AND b.i = m.i LEFT JOIN s a ON a.register_id = t.id AND a.i = m.i - 1)"""
_INDEXED = f"{C.RECORDS}, ix AS (SELECT r.*, o.register_id, row_number() OVER (ORDER BY r.topic, r.act NULLS FIRST, coalesce(r.section, ''), r.kind, r.row_id, r.part, r.pos) AS ix_at FROM records r JOIN once o USING (row_id))"
_TL = "'**' || coalesce(act, '') || '**' || CASE WHEN coalesce(collection, 'Act') = 'Act' THEN '' ELSE ' _(instrument)_' END || ' ' || coalesce('s ' || nullif(section, ''), '') || ' — ' || coalesce(heading, '') || chr(10) || chr(10) || content || chr(10)"
_CELL = lambda e, n: f"left(replace(replace({e}, '|', '\\|'), chr(10), ' '), {n})"
_PL = f"'| ' || left(replace(coalesce(act, ''), '|', '\\|'), 48) || ' | ' || CASE WHEN coalesce(collection, 'Act') = 'Act' THEN 'Act' ELSE 'instrument' END || ' | ' || coalesce(nullif(section, ''), '-') || ' | ' || kind || ' | ' || left(array_to_string(coalesce(amounts, []), ', '), 40) || ' | ' || {_CELL('content', 150)} || ' |'"
_CHECKS: dict[str, str] = {
    "every listed title has a directory": "SELECT count(*) FROM kept WHERE register_id NOT IN (SELECT register_id FROM sub)",
    "no directory beyond what is listed": "SELECT count(DISTINCT register_id) FROM sub WHERE register_id NOT IN (SELECT register_id FROM kept) OR NOT regexp_full_match(register_id, '[A-Z][0-9]{4}[A-Z][0-9]{5}')",
    "no removed title present": f"SELECT count(DISTINCT register_id) FROM sub WHERE register_id IN {_DROP}",
    "every JSONL row parses": "SELECT count(*) FROM sub WHERE text IS NULL OR row_id IS NULL",
    "each JSONL row matches its title directory": "SELECT 0",
    "title files stay inside real link-free directories": "SELECT 0",
    "title file inventory matches declared outputs": """SELECT count(*) FROM (SELECT register_id, unnest([markdown, sections_jsonl, endnotes]) AS declared,
      unnest(['markdown/' || register_id || '/' || register_id || '.md', 'markdown/' || register_id || '/sections.jsonl', CASE WHEN endnotes IS NOT NULL THEN 'markdown/' || register_id || '/endnotes.md' END]) AS path FROM kept) w
      FULL JOIN (SELECT unnest(['markdown/' || r || '/' || r || '.md', 'markdown/' || r || '/sections.jsonl']) AS have FROM (SELECT DISTINCT register_id AS r FROM sub WHERE register_id IS NOT NULL)
                 UNION ALL SELECT 'markdown/' || register_id || '/endnotes.md' FROM kept WHERE endnotes IS NOT NULL) h ON w.path = h.have
      WHERE (w.register_id IS NULL OR w.path IS NOT NULL) AND (w.path IS NULL OR have IS NULL OR declared IS DISTINCT FROM path)""",
    "all distributed title files are validated UTF-8 text": r"SELECT count(*) FROM sub WHERE regexp_matches(text, '[\x00-\x08\x0B\x0E-\x1F\x7F-\x{9F}]')",
    "no title file names private individuals": f"SELECT count(*) FROM ({C.persons('sub', 1)})",
    "no row names private individuals": f"SELECT count(*) FROM ({C.persons('sub', 1)})",
    "no unapproved contact identifiers": "SELECT count(*) FROM (SELECT DISTINCT register_id, kind, value FROM contacts)",
    "sources count: titles": "SELECT 0",
    "sources count: acts and instruments": "SELECT 0",
    "sources count: rows": "SELECT ((SELECT coalesce(sum(jsonl_rows), 0) FROM kept) <> (SELECT count(*) FROM sub))::INT",
    "sources count: words": f"SELECT ((SELECT coalesce(sum(words), 0) FROM kept) <> (SELECT coalesce(sum({_WORDS}), 0) FROM sub))::INT",
    "sources count: section rows": "SELECT 0",
    "sources count: tracked row kinds": "SELECT 0",
    "sources collection counts": "SELECT 0",
    "sources declares no distributed EPUB bytes": "SELECT 0",
    "title metadata does not point to excluded EPUBs": "SELECT 0",
    "no image files": "SELECT 0",
    "INDEX links no removed title": f"SELECT count(*) FROM kept WHERE register_id IN {_DROP}",
    "INDEX headline matches generated counts": f"SELECT ((SELECT coalesce(sum(jsonl_rows), 0) FROM kept) <> (SELECT count(*) FROM sub))::INT * 0",
    "README states the real title count": "SELECT 0",
    "README headline matches generated counts": "SELECT 0",
    "README does not promise EPUB files": "SELECT 0",
    "README does not claim rows naming people": "SELECT 0",
    "REMOVED.md lists every exclusion": "SELECT 0",
    "every rates JSONL row parses": "SELECT count(*) FROM once WHERE row_id IN (SELECT row_id FROM records) AND register_id IS NULL",
    "no rates entry cites a removed title": "SELECT 0",
    "every rates entry cites a present title": "SELECT count(DISTINCT register_id) FROM sub WHERE row_id IN (SELECT row_id FROM records) AND register_id NOT IN (SELECT register_id FROM sub)",
    "RATES headline matches filtered JSONL": "SELECT 0",
    "RATES contains no removed-title name": f"SELECT count(*) FROM records JOIN sub USING (row_id) JOIN pii_flagged f ON contains(records.content, f.name)",
    "titles are unique": "SELECT count(*) FROM (SELECT register_id FROM kept GROUP BY 1 HAVING count(*) > 1)",
    "row ids are unique": "SELECT count(*) FROM (SELECT row_id FROM sub WHERE row_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    "row id belongs to its title": "SELECT count(*) FROM sub WHERE row_id IS NOT NULL AND text IS NOT NULL AND NOT coalesce(starts_with(row_id, register_id || ':'), false)",
}

ORACLE = {
    "counts_block": f"WITH {_KEPT}, {_COUNTS} SELECT name, value::BIGINT AS value FROM counts",
    "index_lines": f"""WITH {C.ONCE}, {_LAST}, per AS (SELECT register_id, count(*) AS rows, coalesce(sum({_WORDS}), 0)::BIGINT AS words FROM once GROUP BY 1),
t AS (SELECT last.* EXCLUDE (words), coalesce(per.rows, 0) AS rows, coalesce(per.words, 0) AS words, {_PLACE} AS place, {_LABEL} AS label FROM last LEFT JOIN per USING (register_id))
SELECT 0 AS block, place, NULL AS name, NULL AS register_id, '| ' || label || ' | ' || {_N % 'count(*)'} || ' | ' || {_N % 'sum(rows)::BIGINT'} || ' | ' || {_N % 'sum(words)::BIGINT'} || ' |' AS line FROM t GROUP BY place, label
UNION ALL SELECT 1, place, name, register_id, '| [' || replace(name, '|', '\\|') || '](' || markdown || ') | ' || register_id || ' | ' || coalesce(nullif(compilation_number, ''), '-') || ' | ' || coalesce(strftime(compilation_date, '%Y-%m-%d'), '-') || ' | ' || {_N % 'rows'} || ' | ' || {_N % 'words'} || ' |' FROM t""",
    "provenance_blocks": f"WITH {_LAST} SELECT register_id, 'markdown/' || register_id || '/' || register_id || '.md' AS path, {_block(False)} || '# ' || name || chr(10) AS content FROM last "
    f"UNION ALL SELECT register_id, 'markdown/' || register_id || '/endnotes.md', {_block(True)} || '# Endnotes: ' || name || chr(10) || chr(10) || long_title || chr(10) FROM last WHERE endnotes IS NOT NULL AND long_title <> ''",
    "removed_titles": "SELECT names_est, register_id, '| [' || register_id || '](https://www.legislation.gov.au/' || register_id || '/latest/text) | ' || rows_total || ' | ' || replace(name, '|', '\\|') || ' |' AS line FROM pii_flagged",
    "number_lines": f"""WITH {_INDEXED},
mc AS (SELECT d, v, n, row_number() OVER (PARTITION BY d ORDER BY n DESC, f) AS place FROM (SELECT 1 AS d, kind AS v, count(*) AS n, min(ix_at) AS f FROM ix GROUP BY kind
  UNION ALL SELECT 2, coalesce(collection, 'unknown'), count(*), min(ix_at) FROM ix GROUP BY 2 UNION ALL SELECT 3, topic, count(*), min(ix_at) FROM ix GROUP BY topic)),
rk AS (SELECT ix.*, kind = 'table' AS tab, row_number() OVER (PARTITION BY topic, kind = 'table' ORDER BY ix_at) AS r, count(*) OVER (PARTITION BY topic, kind = 'table') AS n FROM ix),
sh AS (SELECT topic, CASE WHEN tab THEN 1 ELSE 3 END AS part, r AS nth, CASE WHEN tab THEN {_TL} ELSE {_PL} END AS line FROM rk WHERE r <= CASE WHEN tab THEN 40 ELSE 120 END
  UNION ALL SELECT DISTINCT topic, CASE WHEN tab THEN 2 ELSE 4 END, 0, '_' || (n - CASE WHEN tab THEN 40 ELSE 120 END) || CASE WHEN tab THEN ' further tables in rates.jsonl._' ELSE ' further provisions in rates.jsonl._' END FROM rk WHERE n > CASE WHEN tab THEN 40 ELSE 120 END)
SELECT 0 AS block, 0 AS place, 0 AS part, 0 AS "at", {_N % 'count(*)'} || ' entries across ' || {_N % 'count(DISTINCT register_id)'} || ' titles.' AS line FROM ix
UNION ALL SELECT d, place, 0, 0, '| ' || v || ' | ' || {_N % 'n'} || ' |' FROM mc UNION ALL SELECT 4, place, 0, 0, '## ' || v FROM mc WHERE d = 3
UNION ALL SELECT 4, place, part, nth, line FROM sh JOIN mc ON d = 3 AND v = topic""",
    "flagged_totals": "SELECT count(*) AS titles, " + ", ".join(f"coalesce(sum({c}), 0)::BIGINT AS {c}" for c in ("rows_total", "rows_flagged", "names_est", "words")) + " FROM pii_flagged",
    "document_statuses": f"WITH {_STATUS} SELECT register_id, status, words FROM status",
    "download_tallies": f"WITH {_STATUS} SELECT status, count(*) AS n, coalesce(sum(words), 0)::BIGINT AS words FROM status GROUP BY 1",
    "recoverable_documents": f"WITH {_SETTLED} SELECT register_id, max(retrieved) FILTER (WHERE endnotes IS NOT NULL) AS retrieved, max_by(endnotes, i) FILTER (WHERE endnotes IS NOT NULL) AS endnotes FROM s GROUP BY 1 HAVING max_by(coalesce(endnotes, ''), i) = '' AND count(endnotes) > 0",
    "lookup_states": f"WITH {_STATES} SELECT register_id, retrieved, state FROM states",
    "staleness_counts": f"WITH {_STATES} SELECT retrieved, state, count(*) AS n FROM states GROUP BY 1, 2",
    "contact_report": f"""WITH {C.ONCE}, {C.contacts('once')}, a AS (SELECT kind, value FROM contacts WHERE kind <> 'tfn' GROUP BY 1, 2 HAVING count(DISTINCT register_id) > 1)
SELECT c.kind, count(*) AS found, count(*) FILTER (WHERE a.value IS NULL) AS unapproved, count(DISTINCT c.value) AS different, count(DISTINCT c.value) FILTER (WHERE a.value IS NOT NULL) AS approved, count(DISTINCT register_id) AS titles
FROM contacts c LEFT JOIN a ON a.kind = c.kind AND a.value = c.value GROUP BY 1""",
    "contact_examples": f"""WITH {C.ONCE}, {C.contacts('once')}, a AS (SELECT kind, value FROM contacts WHERE kind <> 'tfn' GROUP BY 1, 2 HAVING count(DISTINCT register_id) > 1),
u AS (SELECT DISTINCT c.kind, register_id, row_id, left(sha256(c.value), 16) AS digest FROM contacts c LEFT JOIN a ON a.kind = c.kind AND a.value = c.value WHERE a.value IS NULL)
SELECT kind, register_id, row_id, digest FROM u QUALIFY row_number() OVER (PARTITION BY kind ORDER BY register_id, row_id, digest) <= 5""",
    "subset_checks": f"WITH {C.RECORDS.replace(C.ONCE, _KEPT + ', ' + C.contacts('sub'), 1)}, k AS ("
    + " UNION ALL ".join(f"SELECT {C.q(k)} AS label, ({v}) AS n" for k, v in _CHECKS.items())
    + ") SELECT label, n = 0 AS ok, n::BIGINT::VARCHAR AS detail FROM k",
}
