"""Queries over the statute corpus for the text, privacy, roll-up and relational operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions import identifiers as I  # noqa: E741
from tabularium.functions import text as X
from tabularium.operators import numbers, privacy, relational, rollup, sequence
from tabularium.plans.corpus_sql import ORACLE  # noqa: F401
from tabularium.sources.tables import once_per_key, spread, table

# What titles are searched for.
KEYWORDS = ["Tax", "Excise", "Superannuation", "Customs Tariff", "Medicare Levy"]
COLLECTIONS = ["Act", "LegislativeInstrument", "NotifiableInstrument"]


def sections(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    """The named columns of every row_id, counted once."""
    s = table(spark, d, "sections").select("row_id", "loaded_at", *columns)
    return once_per_key(spread(s), "row_id", columns, "loaded_at", wide=True) if "text" in columns else once_per_key(s, "row_id", columns, "loaded_at")


def joined(c) -> F.Column:
    return F.array_join(c, "|")


# ---- text scanners


def word_counts(spark, d):
    s = sections(spark, d, ["register_id", "text"])
    return s.groupBy("register_id").agg(F.count("*").alias("rows"), F.coalesce(F.sum(X.word_count(F.col("text"))), F.lit(0)).alias("words"))


def sentences(spark, d):
    s = sections(spark, d, ["text"])
    return s.select("row_id", F.posexplode(X.sentences(F.col("text"))).alias("pos", "sentence"))


def amounts(spark, d):
    t = F.col("text")
    s = sections(spark, d, ["text"])
    return s.select("row_id", joined(X.money_values(t)).alias("money"), joined(X.percentage_values(t)).alias("percent"), joined(X.factor_values(t)).alias("factors"), joined(X.years(t)).alias("years"))


def table_blocks(spark, d):
    s = sections(spark, d, ["text"])
    return s.select("row_id", F.posexplode(X.table_blocks(F.col("text"))).alias("pos", "block")).withColumn("n_lines", F.size(X.lines(F.col("block"))))


def phrases(spark, d):
    t = F.col("text")
    s = sections(spark, d, ["act", "heading", "text"])
    s = s.select("row_id", "heading", "text", X.haystack(F.col("act"), F.col("heading"), t).alias("_hay"))
    return s.select(
        "row_id",
        X.topic_of(F.col("_hay")).alias("topic"),
        X.is_ownership_test(t).alias("ownership"),
        X.has(t, X.INDEX_PHRASE).alias("indexed"),
        X.fold(F.col("heading")).alias("heading_ascii"),
        X.cell(t, 48).alias("cell"),
    )


def number_records(spark, d):
    r = numbers.number_records(sections(spark, d, [*numbers._BASE, "text"]))
    return r.select("row_id", "part", "pos", "kind", "topic", joined("amounts").alias("amounts"), joined("years").alias("years"), "content_ascii", "heading_ascii")


def number_index(spark, d):
    return numbers.number_index(sections(spark, d, [*numbers._BASE, "text"]), ["row_id", "part", "pos", "topic", "kind"])


def number_histograms(spark, d):
    r = numbers.number_records(sections(spark, d, [*numbers._BASE, "text"]))
    return rollup.histograms(r, ["topic", "kind", "collection"])


def top_per_topic(spark, d):
    """The first 40 tables of every topic and how many more there are (the limit is the feature)."""
    r = numbers.number_records(sections(spark, d, [*numbers._BASE, "text"])).where("part = 0")
    keyed = r.withColumn("_section", F.coalesce("section", F.lit("")))
    return sequence.top_per_group(keyed, "topic", ["act", "_section", "row_id", "pos"], 40).select("topic", "row_id", "pos", "rank", "remainder")


# ---- personal data


def person_rows(spark, d):
    return privacy.person_rows(sections(spark, d, ["register_id", "text"]))


def person_titles(spark, d):
    s = sections(spark, d, ["register_id", "text"])
    return privacy.title_rollup(privacy.person_rows(s), s)


def sparse_person_rows(spark, d):
    """A name beside a number, outside the titles that are flagged already."""
    s = relational.without(sections(spark, d, ["register_id", "text"]), "register_id", table(spark, d, "pii_flagged"), "register_id")
    return privacy.person_rows(s, 1, 1)


def _contacts(spark, d):
    return privacy.contact_fingerprints(sections(spark, d, ["register_id", "text"]), ["register_id", "row_id"], "text")


def contact_fingerprints(spark, d):
    return _contacts(spark, d).groupBy("register_id", "row_id", "kind", "sha256").agg(F.count("*").alias("n"))


def check_digits(spark, d):
    """Every run of nine digits in the texts, with or without separators, and whether its check sum holds."""
    runs = F.regexp_extract_all("text", F.lit("[0-9]{3}[ -]?[0-9]{3}[ -]?[0-9]{3}"), F.lit(0))
    n = sections(spark, d, ["text"]).select("row_id", F.posexplode(runs).alias("pos", "value"))
    return n.select("row_id", "pos", "value", I.plausible_tfn(I.digits(F.col("value"))).alias("plausible"))


def pii_summary(spark, d):
    return rollup.pii_summary(table(spark, d, "pii_flagged"))


# ---- relational stages


def _titles(spark, d):
    # rows of one id differ only in repeats and in how the status is spelt
    t = table(spark, d, "titles")
    return relational.first_per_key(t, "id", ["name", "collection", "year", "number", "status", "isPrincipal", "isInForce"])


def _scans() -> list:
    """Every keyword in every collection, one scan each."""
    return [(F.col("collection") == c) & F.col("name").contains(k) for c in COLLECTIONS for k in KEYWORDS]


def discover_titles(spark, d):
    """The principal titles in force that a scan finds, each with the scan that saw it first."""
    t = relational.first_scan(_titles(spark, d).where("isInForce"), _scans())
    return t.where("isPrincipal").select("id", "name", "collection", "isPrincipal", "scan")


def scan_counts(spark, d):
    """How many titles every scan matched, and how many of them no scan before had seen."""
    return relational.scan_counts(_titles(spark, d).where("isInForce"), _scans())


def keywords(spark, d):
    return _titles(spark, d).select("id", joined(X.keywords_in(F.col("name"), KEYWORDS)).alias("keywords"))


def duplicate_titles(spark, d):
    return relational.duplicate_keys(table(spark, d, "titles"), ["id"])


def latest_documents(spark, d):
    """Per title the versions seen and the latest one that has a document."""
    s = table(spark, d, "sources")
    return relational.latest_with(s, "register_id", ["retrieved", "loaded_at"], ["epub"], F.col("epub").isNotNull()).select("register_id", "n_versions", "retrieved", "epub")


def merged_patches(spark, d):
    """Titles with collection and status overwritten by those flagged for persons."""
    p = table(spark, d, "pii_flagged").select(F.col("register_id").alias("id"), F.lit("withheld").alias("status"), F.lit(None).cast("string").alias("number")).distinct()
    return relational.merge_patches(_titles(spark, d).select("id", "name", "status", "number"), p, "id", ["status", "number"])


def looked_up_names(spark, d):
    f = table(spark, d, "pii_flagged").select("register_id", "rows_flagged")
    t = _titles(spark, d).select("id", F.col("name").alias("title_name"), F.col("collection").alias("title_collection"))
    return relational.lookup(f, "register_id", t, "id", ["title_name", "title_collection"], {"title_name": "?"})


def inventory_diff(spark, d):
    titles = table(spark, d, "titles").where("isInForce").select(F.col("id").alias("register_id"))
    return relational.inventory_diff(titles, table(spark, d, "sections").select("register_id"), "register_id")


def removed_lines(spark, d):
    """Section lines that name no title flagged for persons, by substring."""
    s = sections(spark, d, ["text"]).select("row_id", F.posexplode(X.lines(F.col("text"))).alias("pos", "line"))
    return relational.lines_without(s, "line", table(spark, d, "pii_flagged").select("name"))


# ---- sequences


def section_labels(spark, d):
    s = sections(spark, d, ["section", "heading"])
    head = F.concat_ws(" ", F.replace("section", F.lit("-"), F.lit("‑")), F.coalesce("heading", F.lit("")))
    return s.select("row_id", X.section_label(head).alias("label"))


def section_ordinals(spark, d):
    """Row ids made anew from the order within each title."""
    s = sections(spark, d, ["register_id", "section"])
    return sequence.row_ids(s, "register_id", ["row_id"], "section", "made").select("row_id", "made")


def volume_counts(spark, d):
    """Running count of a user's sessions (a view opens one) and the last purchase value carried forward."""
    e = table(spark, d, "events")
    order = ["ts", "event_id"]
    out = sequence.running_count(e, "user_id", order, F.col("event_type") == "view", "volume")
    out = sequence.carry_forward(out, "user_id", order, F.when(F.col("event_type") == "purchase", F.col("event_id")), "last_purchase")
    out = sequence.look_ahead(out, "user_id", order, F.col("event_type"), "next_type")
    return out.select("event_id", "volume", "last_purchase", "next_type")


def line_islands(spark, d):
    """Runs of table and prose lines of every text, with the line before each table as its caption."""
    s = sections(spark, d, ["text"]).select("row_id", F.posexplode(X.lines(F.col("text"))).alias("pos", "line"))
    marked = sequence.islands(s.withColumn("is_table", F.col("line").startswith("|")), "row_id", ["pos"], F.col("is_table"))
    runs = marked.groupBy("row_id", "island").agg(F.bool_or("is_table").alias("is_table"), F.count("*").alias("n_lines"), F.max_by("line", "pos").alias("last_line"))
    caption = F.lag(F.when(F.char_length("last_line") <= 80, F.col("last_line"))).over(sequence.Window.partitionBy("row_id").orderBy("island"))
    tables = runs.withColumn("caption", caption).where("is_table")
    return sequence.nth_of_total(tables, "row_id", ["island"]).select("row_id", "island", "n_lines", "caption", "n", "total")


# ---- roll-ups, subset, reconciliation


def corpus_rollup(spark, d):
    return rollup.corpus_rollup(sections(spark, d, ["register_id", "collection", "section", "text"]))


def kind_histogram(spark, d):
    s = sections(spark, d, ["kind", "section", "granularity"]).withColumn("kind", rollup.kind_or_default())
    return rollup.histograms(s, ["kind", "granularity"])


def _subset(spark, d, columns):
    return relational.without(sections(spark, d, columns), "register_id", table(spark, d, "pii_flagged"), "register_id")


def subset_rollup(spark, d):
    """The corpus without flagged titles, recounted from its rows."""
    return rollup.corpus_rollup(_subset(spark, d, ["register_id", "collection", "section", "text"]))


def reconciliation(spark, d):
    """Declared against recounted rows of every title in the last snapshot."""
    s = table(spark, d, "sources")
    last = s.groupBy("register_id").agg(F.max(F.struct("retrieved", "loaded_at", "jsonl_rows")).alias("r")).select("register_id", F.col("r.jsonl_rows").alias("declared"))
    got = rollup.per_title(sections(spark, d, ["register_id", "section", "text"])).select("register_id", F.col("rows").alias("counted"))
    j = last.join(got, "register_id", "full_outer")
    return j.select("register_id", "declared", "counted", F.col("declared").eqNullSafe(F.col("counted")).alias("agrees"))


_NAMES = """word_counts sentences amounts table_blocks phrases number_records number_index number_histograms top_per_topic person_rows
person_titles sparse_person_rows contact_fingerprints check_digits pii_summary discover_titles scan_counts keywords duplicate_titles
latest_documents merged_patches looked_up_names inventory_diff removed_lines section_labels section_ordinals volume_counts
line_islands corpus_rollup kind_histogram subset_rollup reconciliation"""
QUERIES = {n: globals()[n] for n in _NAMES.split()}

