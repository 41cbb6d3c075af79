"""Stages as runs: each reads whole tables, holds its gate, and only then hands on or publishes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators import publication, relational
from tabularium.operators.numbers import _BASE, number_index
from tabularium.operators.sections import require_read, section_documents
from tabularium.operators.sections import section_rows as rows_of
from tabularium.session import materialise
from tabularium.sources.publish import publish


def resolve_versions(titles: DataFrame, versions: DataFrame) -> DataFrame:
    """Titles (id, ...) with their current version (start as versionStart, compilationNumber, registerId as compilationRegisterId).

    versions: titleId, start, isCurrent, compilationNumber, registerId. Raises
    GateError if any title has no current version, naming five at most.
    """
    now = versions.where("isCurrent").groupBy(F.col("titleId").alias("_t")).agg(F.max(F.struct("start", "compilationNumber", "registerId")).alias("v"))
    relational.require_found(titles, "id", now, "_t", "titles without a current version")
    j = titles.join(now, F.col("id") == F.col("_t"))
    return j.select(*titles.columns, F.col("v.start").alias("versionStart"), F.col("v.compilationNumber").alias("compilationNumber"), F.col("v.registerId").alias("compilationRegisterId"))


def latest_documents(lookups: DataFrame, versions: DataFrame) -> DataFrame:
    """Per looked-up title the number of versions and the latest one that has a document.

    lookups: id, ok; versions as in resolve_versions(). Raises GateError if any
    lookup failed or found no history.
    """
    relational.require_empty(lookups.where("NOT coalesce(ok, false)").select("id"), "failed lookups of histories", ["id"])
    relational.require_found(lookups, "id", versions, "titleId", "titles without a history")
    mine = versions.join(lookups.select(F.col("id").alias("_i")), F.col("titleId") == F.col("_i"), "left_semi")
    return relational.latest_with(mine, "titleId", ["start"], ["compilationNumber", "registerId"], F.col("registerId").isNotNull())


def recovered(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of a manifest (id, epub, ...) without a document for which latest_documents() found one, with that version."""
    f = found.where("registerId IS NOT NULL").select(F.col("titleId").alias("_t"), F.col("start").alias("latest_start"), F.col("registerId").alias("latest_document"))
    return manifest.where("epub IS NULL").join(f, F.col("id") == F.col("_t")).drop("_t")


def publish_corpus(spark: SparkSession, root: str, titles: DataFrame, documents: DataFrame, source: str) -> str:
    """Chunk all documents and publish them with their rows, numbers and counts as one version; returns its folder.

    titles has the columns of a title list (register_id, name, collection, ...);
    documents: register_id and `source`, the archives or texts. Nothing is
    written unless every title has a document and every document can be read.
    Counts are taken from the rows that were written, and checked against them.
    """
    relational.require_some(titles, "no titles")
    relational.require_found(titles, "register_id", documents, "register_id", "titles without a document")
    named = documents.join(titles.select("register_id", F.col("name").alias("_name")), "register_id")
    read = materialise(section_documents(named, "register_id", "_name", source))
    require_read(read, "register_id")
    t = titles.join(read.select(F.col("register_id").alias("_r"), F.col("granularity").alias("granularity_"), F.col("words").alias("words_")), F.col("register_id") == F.col("_r"))
    t = t.drop("_r", "granularity", "words").withColumnsRenamed({"granularity_": "granularity", "words_": "words"})
    about = titles.select("register_id", F.col("name").alias("act"), "collection", "compilation_number", "compilation_date", "register_page")
    rows = materialise(rows_of(read, "register_id").join(about, "register_id"))
    numbers = number_index(rows.select(*_BASE, "row_id", "text"))
    counts = publication.counts_block(t, rows, titles.limit(0))

    def verify(p: dict[str, DataFrame]) -> DataFrame:
        again = publication.counts_block(p["titles"], p["sections"], p["titles"].limit(0))
        differ = again.exceptAll(p["counts"]).union(p["counts"].exceptAll(again))
        twice = relational.duplicate_keys(p["sections"], ["row_id"])
        stray = p["numbers"].join(p["sections"], "row_id", "left_anti")
        one = lambda df, label: df.agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail"))
        return one(differ, "counts hold").union(one(twice, "row ids are unique")).union(one(stray, "numbers belong to rows"))

    return publish(spark, root, {"titles": t, "sections": rows, "numbers": numbers, "counts": counts, "documents": read.drop("rows")}, verify)
