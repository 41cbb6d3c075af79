"""Queries of the document reader, the contracts, the checks and the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators import blocks, contract
from tabularium.operators import sections as chunking
from tabularium.operators.snapshots import Calendar
from tabularium.plans.corpus_queries import sections
from tabularium.session import shared_dir
from tabularium.sources.tables import spread, table
from tabularium.streaming.ingest import latest_updates, publish_updates, windowed_counts


def _escaped(c) -> F.Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Every row as an XHTML document of its own: its label and heading (or its title's name, if it has neither), then its paragraphs."""
    s = sections(spark, d, ["act", "section", "heading", "text"])
    head = F.concat_ws(" ", "section", "heading")
    head = _escaped(F.when(F.trim(head) == "", F.col("act")).otherwise(head))
    body = F.replace(_escaped(F.coalesce("text", F.lit(""))), F.lit("\n\n"), F.lit('</p><p class="subsection">'))
    html = F.concat(F.lit('<p class="ActHead5"><span class="CharSectno">'), head, F.lit('</span></p><p class="subsection">'), body, F.lit("</p>"))
    return spread(s.select("row_id", "act", html.alias("html")))


def block_scan(spark, d):
    """The blocks of every document and the characters of its paragraphs."""
    b = blocks.exploded(blocks.read_html(_documents(spark, d), "row_id", "html"), "row_id")
    chars = F.coalesce(F.sum(F.when(F.col("k") == "p", F.char_length("text"))), F.lit(0))
    return b.groupBy("row_id").agg(F.count("*").alias("blocks"), F.count_if(F.col("k") == "p").alias("paragraphs"), F.count_if("sectno").alias("headings"), chars.alias("chars"))


def section_rows(spark, d):
    """Rows made anew from the documents: the label read from the heading, and the text."""
    made = chunking.section_documents(_documents(spark, d), "row_id", "act", "html")
    return made.select("row_id", "granularity", "error", F.explode("rows").alias("r")).select("row_id", "granularity", "error", "r.ordinal", "r.section", "r.kind", F.char_length("r.text").alias("chars"))


VOLUME = 50  # rows of a title in one document


def table_chunk_rows(spark, d):
    """Chunks of the documents without sections, put together again from their rows in volumes of fifty."""
    s = sections(spark, d, ["register_id", "act", "granularity", "text"]).where("granularity <> 'section'")
    volume = F.floor(F.regexp_extract("row_id", r"^[^:]*:(\d+)", 1).cast("int") / VOLUME).cast("int")
    docs = s.groupBy("register_id", volume.alias("volume")).agg(F.max("act").alias("act"), F.array_sort(F.collect_list(F.struct("row_id", "text"))).alias("r"))
    docs = docs.select("register_id", "volume", "act", F.array_join(F.transform("r", lambda x: x["text"]), "\n\n").alias("body"))
    return chunking.table_chunks(docs, ["register_id", "volume"], "act", "body")


def _last_snapshot(spark, d):
    s = table(spark, d, "sources")
    cols = ["name", "collection", "compilation_number", "compilation_date", "version_is_current", "current_version_start", "retrieved", "source_url", "register_page"]
    last = s.groupBy("register_id").agg(F.max(F.struct("retrieved", "loaded_at", *[c for c in cols if c != "retrieved"])).alias("r"))
    text = lambda c: F.col(f"r.{c}").cast("string").alias(c)
    return last.select("register_id", *[F.col(f"r.{c}") if c == "version_is_current" else text(c) for c in cols])


def baseline_violations(spark, d):
    return contract.baseline_violations(_last_snapshot(spark, d)).distinct()


def baseline_rows(spark, d):
    return contract.baseline(_last_snapshot(spark, d))


def _ends(spark, d):
    """(baseline, observed): every title's row in the snapshot before the last, and in the last."""
    s = table(spark, d, "sources")
    cols = ["name", "collection", "compilation_number", "compilation_date", "version_is_current", "current_version_start", "epub", "source_url", "register_page", "loaded_at"]
    one = s.where("register_id IS NOT NULL AND retrieved IS NOT NULL").groupBy("register_id", "retrieved").agg(F.max(F.struct("loaded_at", *[c for c in cols if c != "loaded_at"])).alias("r"))
    rows = one.select("register_id", "retrieved", *[F.col(f"r.{c}").alias(c) for c in cols])
    dates = Calendar(s, "retrieved")
    placed = dates.join(rows)
    last = dates.dates.where(F.col("_next").isNull()).select(F.col("_i").alias("_last"))
    return placed.join(last, F.col("_i") == F.col("_last") - 1, "left_semi"), placed.where(F.col("_next").isNull())


def _observations(spark, d):
    """What a check of the last snapshot reports of the titles of the one before, with the fields that the snapshot has for it."""
    base, new = _ends(spark, d)
    n = new.select(F.col("register_id").alias("_r"), *[F.col(c).alias(f"n_{c}") for c in ("compilation_number", "compilation_date", "version_is_current", "current_version_start", "epub", "loaded_at")])
    j = base.join(n, F.col("register_id") == F.col("_r"), "left")
    gone = F.col("_r").isNull()
    failed = F.col("n_compilation_number").isNull() & F.col("n_compilation_date").isNull()
    same = F.col("n_compilation_number").eqNullSafe(F.col("compilation_number")) & F.col("n_compilation_date").eqNullSafe(F.col("compilation_date"))
    state = F.when(gone, "NO_LONGER_IN_FORCE").when(failed, "LOOKUP_FAILED").when(~F.col("n_version_is_current"), "CURRENT_NO_PUBLISHED_COMPILATION").when(same, "UNCHANGED").otherwise("SUPERSEDED")
    text = lambda c: F.col(c).cast("string")
    return j.withColumn("state", state).select(
        "register_id",
        "collection",
        "state",
        F.when(F.col("state") == "SUPERSEDED", F.col("n_compilation_number")).alias("observed_compilation_number"),
        F.when(F.col("state") == "SUPERSEDED", text("n_compilation_date")).alias("observed_compilation_date"),
        F.when(F.col("state") == "SUPERSEDED", F.col("n_epub")).alias("observed_register_document_id"),
        text("n_current_version_start").alias("current_version_start"),
        F.col("register_page").alias("evidence_url"),
        F.date_format("n_loaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("checked_at"),
        F.when(F.col("state") == "LOOKUP_FAILED", "no version").alias("error_category"),
    ), base


def observation_violations(spark, d):
    seen, base = _observations(spark, d)
    return contract.observation_violations(seen, base, complete=True)


def stream_event_windows(spark, d):
    """Events per day and type, counted by a stream that reads the table once."""
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windowed_counts(stream, "ts", "event_type", "1 day", "1 hour")
    out = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    publish_updates(counts, out + "/rows", out + "/state").awaitTermination()
    return latest_updates(spark, out + "/rows", ["start", "event_type"])


QUERIES = {
    f.__name__: f
    for f in (block_scan, section_rows, table_chunk_rows, baseline_violations, baseline_rows, observation_violations, stream_event_windows)
}

_ONCE = "once AS (SELECT * FROM sections QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
_LAST = """last AS (SELECT register_id, name, collection, compilation_number, compilation_date::VARCHAR AS compilation_date, version_is_current,
 current_version_start::VARCHAR AS current_version_start, retrieved::VARCHAR AS retrieved, source_url, register_page FROM sources
 QUALIFY row_number() OVER (PARTITION BY register_id ORDER BY retrieved DESC, loaded_at DESC) = 1)"""
_TEXT = lambda c: f"coalesce(trim({c}) <> '' AND NOT regexp_matches({c}, '[\\x00-\\x1F\\x7F]'), false)"
_DATE = lambda c: f"coalesce(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST({c} AS DATE) IS NOT NULL, false)"
_URL = lambda c: f"coalesce(regexp_full_match({c}, '(?i)https://[^\\s/?#@:]+([/?#]\\S*)?'), false)"
_IN = "collection IN ('Act', 'LegislativeInstrument', 'NotifiableInstrument')"
_RULES = {
    "register_id": _TEXT("register_id"), "name": _TEXT("name"), "collection": f"coalesce({_IN}, false)", "compilation_number": _TEXT("compilation_number"),
    "compilation_date": _DATE("compilation_date"), "version_is_current": "version_is_current IS NOT NULL",
    "current_version_start": f"CASE WHEN current_version_start IS NULL THEN coalesce(version_is_current, false) ELSE {_DATE('current_version_start')} END",
    "retrieved": _DATE("retrieved"), "source_url": _URL("source_url"), "register_page": _URL("register_page"),
}
_WS = r"[\s\p{Z}\x{0085}\x{001C}-\x{001F}]"
_PARAS = f"list_filter(string_split(coalesce(text, ''), chr(10) || chr(10)), lambda z: regexp_replace(z, '{_WS}+', '', 'g') <> '')"
_ANY = f"regexp_replace(concat_ws(' ', section, heading), '{_WS}+', '', 'g') <> ''"
_TITLE = "CASE WHEN trim(concat_ws(' ', section, heading)) = '' THEN act ELSE concat_ws(' ', section, heading) END"
_NORM = lambda e: f"regexp_replace(regexp_replace(regexp_replace(replace({e}, chr(160), ' '), '[ \\t]+', ' ', 'g'), '^{_WS}+', ''), '{_WS}+$', '')"
_HEAD = f"({_NORM(_TITLE)} <> '')::INT"
_CHARS = f"coalesce(list_sum(list_transform({_PARAS}, lambda z: length({_NORM('z')}))), 0)::BIGINT"
_TABLES = f"""
doc AS (SELECT register_id, regexp_extract(row_id, '^[^:]*:(\\d+)', 1)::INT // 50 AS volume, max(act) AS act, string_agg(text, chr(10) || chr(10) ORDER BY row_id) AS body FROM once WHERE granularity <> 'section' GROUP BY 1, 2),
l AS (SELECT register_id, volume, act, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM (SELECT *, string_split(body, chr(10)) AS ls FROM doc)),
m AS (SELECT *, starts_with(line, '|') AS tab, regexp_replace(regexp_replace(line, '^{_WS}+', ''), '{_WS}+$', '') AS said,
  coalesce(lag(starts_with(line, '|')) OVER (PARTITION BY register_id, volume ORDER BY pos) <> starts_with(line, '|'), true)::INT AS fresh FROM l),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY register_id, volume ORDER BY pos) AS island FROM m),
k AS (SELECT * FROM i WHERE tab OR (said <> '' AND NOT starts_with(said, '#'))),
w AS (SELECT *, len(regexp_extract_all(line, '[^' || chr(32) || '\\s\\p{{Z}}]+')) AS words, tab AND count(*) OVER (PARTITION BY register_id, volume, island) >= 3 AS big FROM k),
t AS (SELECT register_id, volume, count(DISTINCT island) FILTER (WHERE big) AS n, coalesce(sum(words) FILTER (WHERE big), 0) AS tw, coalesce(sum(words) FILTER (WHERE NOT tab), 0) AS pw FROM w GROUP BY 1, 2),
o AS (SELECT register_id, volume, island, row_number() OVER (PARTITION BY register_id, volume ORDER BY island) AS nth FROM (SELECT DISTINCT register_id, volume, island FROM w WHERE big)),
g AS (SELECT w.*, (SELECT count(*) FROM o WHERE o.register_id = w.register_id AND o.volume = w.volume AND o.island < w.island) AS g FROM w),
c AS (SELECT register_id, volume, act, g, list(CASE WHEN tab THEN line ELSE said END ORDER BY pos) FILTER (WHERE NOT big) AS lead, list(line ORDER BY pos) FILTER (WHERE big) AS tab, sum(words) FILTER (WHERE NOT big) AS lw,
  arg_max(words, pos) FILTER (WHERE NOT big) AS last_words FROM g GROUP BY 1, 2, 3, 4),
x AS (SELECT c.*, t.n AS total, CASE WHEN length(lead[-1]) <= 80 THEN lead[-1] END AS caption FROM c JOIN t USING (register_id, volume) WHERE t.n >= 3 AND tw >= 2 * pw),
y AS (SELECT *, coalesce(lw, 0) - CASE WHEN caption IS NOT NULL THEN last_words ELSE 0 END > 120 AS long FROM x),
z AS (SELECT register_id, volume, g, 0 AS part, act || ' — opening provisions' AS heading, 'text_block' AS kind, CASE WHEN caption IS NULL THEN lead ELSE lead[:-2] END AS lines FROM y WHERE tab IS NOT NULL AND long
  UNION ALL SELECT register_id, volume, g, 1, act || ' — ' || coalesce(caption, 'table ' || (g + 1) || ' of ' || total), 'table_block', list_concat(CASE WHEN NOT long THEN coalesce(lead, []) WHEN caption IS NULL THEN [] ELSE [caption] END, tab) FROM y WHERE tab IS NOT NULL
  UNION ALL SELECT register_id, volume, g, 2, act || ' — closing provisions', 'text_block', lead FROM y WHERE tab IS NULL)"""
_OBS = """st AS (SELECT * FROM sources WHERE register_id IS NOT NULL AND retrieved IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY register_id, retrieved ORDER BY loaded_at DESC NULLS LAST) = 1),
dates AS (SELECT DISTINCT retrieved FROM sources WHERE retrieved IS NOT NULL ORDER BY retrieved DESC LIMIT 2),
b AS (SELECT * FROM st WHERE retrieved = (SELECT min(retrieved) FROM dates)), n AS (SELECT * FROM st WHERE retrieved = (SELECT max(retrieved) FROM dates)),
obs AS (SELECT b.register_id, b.collection, b.register_page, n.compilation_number AS number, n.compilation_date AS day, n.epub AS doc, n.current_version_start AS start, n.loaded_at AS seen,
 CASE WHEN n.register_id IS NULL THEN 'NO_LONGER_IN_FORCE' WHEN n.compilation_number IS NULL AND n.compilation_date IS NULL THEN 'LOOKUP_FAILED' WHEN NOT n.version_is_current THEN 'CURRENT_NO_PUBLISHED_COMPILATION'
  WHEN n.compilation_number IS NOT DISTINCT FROM b.compilation_number AND n.compilation_date IS NOT DISTINCT FROM b.compilation_date THEN 'UNCHANGED' ELSE 'SUPERSEDED' END AS state
 FROM b LEFT JOIN n USING (register_id))"""

ORACLE = {
    "block_scan": f"WITH {_ONCE} SELECT row_id, 1 + {_HEAD} + len({_PARAS}) AS blocks, {_HEAD} + len({_PARAS}) AS paragraphs, {_HEAD} AS headings, length({_NORM(_TITLE)}) + {_CHARS} AS chars FROM once",
    "section_rows": f"""WITH {_ONCE}, h AS (SELECT row_id, act, {_NORM(_TITLE)} AS head, {_CHARS} AS chars, len({_PARAS}) AS paras FROM once),
n AS (SELECT *, regexp_extract(head, '^(\\p{{Nd}}{{1,3}}[A-Z]{{0,4}})[\\s\\p{{Z}}]*\\x{{2011}}[\\s\\p{{Z}}]*(\\p{{Nd}}{{1,4}}[A-Z]{{0,8}})', ['a', 'b']) AS d, regexp_extract(head, '^(\\p{{Nd}}{{1,4}}[A-Z]{{0,8}})([.\\s\\p{{Z}}\\x{{2011}}]|$)', 1) AS p FROM h),
s AS (SELECT *, CASE WHEN d.a <> '' THEN d.a || '-' || d.b WHEN p <> '' THEN p END AS section FROM n)
SELECT row_id, CASE WHEN paras > 0 THEN 'section' ELSE 'whole_act' END AS granularity, NULL AS error, 1 AS ordinal, CASE WHEN paras > 0 THEN section END AS section,
 CASE WHEN paras = 0 THEN 'whole_act' WHEN section IS NULL THEN 'unnumbered' ELSE 'section' END AS kind, CASE WHEN paras > 0 THEN chars + 2 * (paras - 1) ELSE length('# ' || act || chr(10) || chr(10) || '##### ' || head) END AS chars FROM s""",
    "table_chunk_rows": f"WITH {_ONCE}, {_TABLES} SELECT register_id, volume, row_number() OVER (PARTITION BY register_id, volume ORDER BY g, part) - 1 AS n, heading, kind, regexp_replace(regexp_replace(array_to_string(lines, chr(10)), '^{_WS}+', ''), '{_WS}+$', '') AS text, 0 AS lost FROM z",
    "baseline_rows": f"WITH {_LAST} SELECT * FROM last",
    "baseline_violations": f"WITH {_LAST} " + " UNION ALL ".join(f"SELECT register_id, '{k}' AS rule FROM last WHERE NOT ({v})" for k, v in _RULES.items()),
    "observation_violations": f"""WITH {_OBS}
SELECT register_id, 'observed_compilation_number' AS rule FROM obs WHERE state = 'SUPERSEDED' AND coalesce(trim(number), '') = ''
UNION ALL SELECT register_id, 'observed_compilation_date' FROM obs WHERE state = 'SUPERSEDED' AND day IS NULL
UNION ALL SELECT register_id, 'observed_register_document_id' FROM obs WHERE state = 'SUPERSEDED' AND coalesce(trim(doc), '') = ''
UNION ALL SELECT register_id, 'current_version_start' FROM obs WHERE (state = 'CURRENT_NO_PUBLISHED_COMPILATION') <> (start IS NOT NULL)
UNION ALL SELECT register_id, 'evidence_url' FROM obs WHERE NOT {_URL('register_page')}
UNION ALL SELECT register_id, 'collection' FROM obs WHERE false
UNION ALL SELECT register_id, 'checked_at' FROM obs WHERE seen IS NULL""",
    "stream_event_windows": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
