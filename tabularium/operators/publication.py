"""What a corpus is published as: documents with provenance, counts, and readable indexes.

Indexes are tables of lines with the columns they are ordered by, so they are
rendered where the data is; write_lines() puts them into files. One document
is one row, as it is everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.text import cell, word_count
from tabularium.functions.text import thousands_text as thousands
from tabularium.operators.rollup import has_text, kind_or_default
from tabularium.operators.sequence import top_per_group

# Licence, the wording the register asks for, labels, limits and formats of the published files.
LICENCE = "CC BY 4.0"
LICENCE_URL = "https://creativecommons.org/licenses/by/4.0/"
ATTRIBUTION = (
    "Based on content from the Federal Register of Legislation at %s. For the latest information on Australian Government legislation "
    "please go to https://www.legislation.gov.au. Changes: converted from EPUB to markdown, contents pages removed, endnotes separated, "
    "images replaced by their descriptive alt text, compilation cover pages and running headers omitted."
)
COLLECTION_LABELS = {"Act": "Acts", "LegislativeInstrument": "Legislative instruments", "NotifiableInstrument": "Notifiable instruments"}
TABLES_SHOWN, PROVISIONS_SHOWN = 40, 120
NAME_CELL, AMOUNTS_CELL, CONTENT_CELL = 48, 40, 150
INDEX_HEADLINE = "%s titles (%d Acts, %d instruments), %s retrieval rows, %s words."
NUMBERS_HEADLINE = "%s entries across %s titles."


def attribution(retrieved: Column) -> Column:
    """The provenance sentence for changed material, with the date of retrieval; null without one."""
    return F.when(retrieved.isNotNull(), F.format_string(ATTRIBUTION, retrieved.cast("string")))


def quoted(c: Column) -> Column:
    """A text as a JSON string in ASCII: everything else is escaped, beyond the basic plane as a pair. Null is an empty string."""
    inside = F.to_json(F.array(F.coalesce(c, F.lit(""))))
    plain = F.substring(inside, F.lit(2), F.char_length(inside) - 2)
    unit = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))
    rest = lambda ch: F.ascii(ch) - 0x10000
    pair = lambda ch: F.concat(unit(F.lit(0xD800) + F.shiftright(rest(ch), 10)), unit(F.lit(0xDC00) + rest(ch).bitwiseAND(0x3FF)))
    escaped = lambda ch: F.when(F.ascii(ch) < 128, ch).when(F.ascii(ch) < 0x10000, unit(F.ascii(ch))).otherwise(pair(ch))
    return F.when(plain.rlike(r"\A[\x00-\x7F]*\z"), plain).otherwise(F.array_join(F.transform(F.split(plain, ""), escaped), ""))


def _or_null(c: str) -> Column:
    return F.when(has_text(c), F.col(c)).otherwise("null")


def front_matter(endnotes: bool = False) -> Column:
    """The provenance block of a document, from the columns of a title list; `endnotes` for a file of end notes."""
    name = F.concat(F.lit("Endnotes: "), F.col("name")) if endnotes else F.col("name")
    fields: list[tuple[str, Column]] = [("register_id", F.col("register_id")), ("title", quoted(name))]
    if not endnotes:
        fields.append(("long_title", quoted(F.col("long_title"))))
    fields += [("collection", _or_null("collection")), ("compilation_number", _or_null("compilation_number")), ("compilation_date", F.coalesce(F.col("compilation_date").cast("string"), F.lit("None")))]
    if not endnotes:
        fields += [
            ("version_is_current", F.when(F.col("version_is_current") == F.lit(False), "false").otherwise("true")),
            ("superseded_from", F.coalesce(F.col("current_version_start").cast("string"), F.lit("null"))),
        ]
    fields += [
        ("source_url", F.coalesce("source_url", F.lit(""))),
        ("register_page", F.coalesce("register_page", F.lit(""))),
        ("retrieved", F.col("retrieved").cast("string")),
        ("licence", F.lit(LICENCE)),
        ("licence_url", F.lit(LICENCE_URL)),
        ("authorised", F.lit("false")),
        ("attribution", quoted(attribution(F.col("retrieved")))),
    ]
    return F.concat(F.lit("---\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\n")) for k, v in fields], F.lit("---\n"))


def title_documents(titles: DataFrame) -> DataFrame:
    """(register_id, path, content): the markdown of every title and, where there are any, its end notes, each with its own provenance.

    titles has the columns of the title list, `markdown` (the body) and
    `endnotes_text`; a null body is an empty one.
    """
    folder = F.concat(F.lit("markdown/"), F.col("register_id"), F.lit("/"))
    body = F.struct(F.concat(folder, F.col("register_id"), F.lit(".md")).alias("path"), F.concat(front_matter(), F.coalesce("markdown", F.lit("")), F.lit("\n")).alias("content"))
    said = F.concat(front_matter(endnotes=True), F.lit("# Endnotes: "), F.col("name"), F.lit("\n\n"), F.col("endnotes_text"), F.lit("\n"))
    notes = F.when(has_text("endnotes_text"), F.struct(F.concat(folder, F.lit("endnotes.md")).alias("path"), said.alias("content")))
    return titles.select("register_id", F.inline(F.array_compact(F.array(body, notes))))


def row_facts(sections: DataFrame, titles: DataFrame) -> DataFrame:
    """(collection, rows, section_rows, words, container, unnumbered, introductory): per collection of the row, or of its title if it has none.

    Aggregated per (row's collection, title) first, so only those pairs meet the titles.
    """
    kind = kind_or_default()
    per = sections.groupBy("register_id", "collection").agg(
        F.count("*").alias("rows"),
        F.count_if(has_text("section")).alias("section_rows"),
        F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0)).alias("words"),
        *[F.count_if(kind == k).alias(k) for k in ("container", "unnumbered", "introductory")],
    )
    t = titles.select(F.col("register_id").alias("_id"), F.col("collection").alias("_c"))
    named = per.join(t, F.col("register_id") == F.col("_id"), "left")
    coll = F.when(has_text("collection"), F.col("collection")).when(has_text("_c"), F.col("_c")).otherwise("unknown")
    sums = ["rows", "section_rows", "words", "container", "unnumbered", "introductory"]
    return named.groupBy(coll.alias("collection")).agg(*[F.sum(c).alias(c) for c in sums])


def counts_block(titles: DataFrame, sections: DataFrame, unavailable: DataFrame) -> DataFrame:
    """(name, value) of the counts a title list announces; by collection as `by_collection.<collection>.<titles|rows|words>`.

    titles is unique by register_id; unavailable are titles without a document.
    All are recounted from the rows, none is taken over.
    """
    is_act = F.col("collection") == "Act"
    missing = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    of_titles = {
        "titles": F.count("*"),
        "acts": F.count_if(is_act),
        "instruments": F.count_if(F.coalesce(~is_act, F.lit(True))),
        "titles_no_keyword_in_current_name": F.count_if(missing("keywords_in_name")),
        "titles_whole_act_chunk": F.count_if(F.col("granularity") == "whole_act"),
        "titles_table_block_chunk": F.count_if(F.col("granularity") == "table_block"),
        "titles_with_endnotes": F.count_if(has_text("endnotes")),
        "titles_not_current_version": F.count_if(F.col("version_is_current") == F.lit(False)),
        "epub_bytes": F.lit(0).cast("bigint"),
    }
    facts = row_facts(sections, titles)
    of_rows = {
        "jsonl_rows": "rows", "words_body_only": "words", "rows_with_section_id": "section_rows", "rows_container": "container",
        "rows_unnumbered": "unnumbered", "rows_introductory": "introductory",
    }
    stack = lambda df, names: df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("value")) for n in names])))
    one = stack(titles.agg(*[e.alias(n) for n, e in of_titles.items()]), of_titles)
    two = stack(facts.agg(*[F.sum(c).alias(n) for n, c in of_rows.items()]), of_rows)
    three = unavailable.agg(F.count("*").alias("value")).select(F.lit("titles_without_epub").alias("name"), "value")
    by = titles.groupBy(F.coalesce("collection", F.lit("unknown")).alias("c")).agg(F.count("*").alias("titles"))
    both = by.join(facts.select(F.col("collection").alias("c"), "rows", "words"), "c", "left")
    four = both.select(F.inline(F.array(*[F.struct(F.concat(F.lit("by_collection."), F.col("c"), F.lit(f".{k}")).alias("name"), F.coalesce(F.col(k), F.lit(0)).alias("value")) for k in ("titles", "rows", "words")])))
    return one.unionByName(two).unionByName(three).unionByName(four)


def index_headline(counts: DataFrame) -> DataFrame:
    """(line): the headline of the index, from a counts_block()."""
    value = lambda n: F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0))
    return counts.agg(
        F.format_string(INDEX_HEADLINE, thousands(value("titles")), value("acts"), value("instruments"), thousands(value("jsonl_rows")), thousands(value("words_body_only"))).alias("line")
    )


def index_lines(titles: DataFrame, per_title: DataFrame) -> DataFrame:
    """(block, name, register_id, line) of the index of titles, in that order.

    Block 0 has the totals of every collection, block 1 the titles; both go
    through the labelled collections in their order, others last. per_title
    has (register_id, rows, words).
    """
    t = titles.drop("rows", "words").join(per_title.select("register_id", "rows", "words"), "register_id", "left").na.fill(0, ["rows", "words"])
    keys = list(COLLECTION_LABELS)
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, keys)), F.col("collection")), F.lit(0)), F.lit(len(keys) + 1)).cast("int")
    label = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in COLLECTION_LABELS.items() for x in kv]), F.col("collection")), F.lit("Other collections"))
    sums = t.groupBy(rank.alias("place"), label.alias("name")).agg(F.count("*").alias("n"), F.sum("rows").alias("r"), F.sum("words").alias("w"))
    row = lambda *parts: F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    none = F.lit(None).cast("string")
    totals = sums.select(F.lit(0).alias("block"), "place", none.alias("name"), none.alias("register_id"), row(F.col("name"), thousands(F.col("n")), thousands(F.col("r")), thousands(F.col("w"))).alias("line"))
    link = F.concat(F.lit("["), F.replace("name", F.lit("|"), F.lit("\\|")), F.lit("]("), F.coalesce("markdown", F.lit("")), F.lit(")"))
    dash = lambda c: F.when(has_text(c), F.col(c)).otherwise("-")
    one = t.select(
        F.lit(1).alias("block"),
        rank.alias("place"),
        "name",
        "register_id",
        row(link, F.col("register_id"), dash("compilation_number"), F.coalesce(F.col("compilation_date").cast("string"), F.lit("-")), thousands(F.col("rows")), thousands(F.col("words"))).alias("line"),
    )
    return totals.unionByName(one)


def removed_lines(removed: DataFrame) -> DataFrame:
    """(names_est, register_id, line) of the list of titles left out, most names first."""
    link = F.format_string("[%s](https://www.legislation.gov.au/%s/latest/text)", "register_id", "register_id")
    line = F.concat(F.lit("| "), F.concat_ws(" | ", link, F.col("rows_total").cast("string"), F.replace("name", F.lit("|"), F.lit("\\|"))), F.lit(" |"))
    return removed.select("names_est", "register_id", line.alias("line")).orderBy(F.col("names_est").desc(), "register_id")


def most_common(records: DataFrame, by: str, position: str, default: str = "unknown") -> DataFrame:
    """(value, n, first, place): counts in descending order, ties by the first position. Nulls count as `default`."""
    counted = records.groupBy(F.coalesce(F.col(by), F.lit(default)).alias("value")).agg(F.count("*").alias("n"), F.min(position).alias("first"))
    # one row per value by now
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "first")))


def number_lines(records: DataFrame, position: str) -> DataFrame:
    """(block, place, part, at, line) of the readable index of numbers, in that order.

    Block 0 is the headline, 1 to 3 count kinds, collections and topics, 4 has
    a section per topic: its first 40 tables (part 1), its first 120
    provisions (part 3) and how many more there are (parts 2 and 4). records
    are number records with their `position` in the published order.
    """
    lit = lambda n: F.lit(n).cast("bigint")
    head = records.agg(F.format_string(NUMBERS_HEADLINE, thousands(F.count("*")), thousands(F.countDistinct("register_id"))).alias("line"))
    out = head.select(F.lit(0).alias("block"), F.lit(0).alias("place"), F.lit(0).alias("part"), lit(0).alias("at"), "line")
    topics = most_common(records, "topic", position)
    for block, df in ((1, most_common(records, "kind", position)), (2, most_common(records, "collection", position)), (3, topics)):
        out = out.unionByName(df.select(F.lit(block).alias("block"), "place", F.lit(0).alias("part"), lit(0).alias("at"), F.format_string("| %s | %s |", "value", thousands(F.col("n"))).alias("line")))
    out = out.unionByName(topics.select(F.lit(4).alias("block"), "place", F.lit(0).alias("part"), lit(0).alias("at"), F.concat(F.lit("## "), F.col("value")).alias("line")))
    is_act = F.coalesce("collection", F.lit("Act")) == "Act"
    place = topics.select(F.col("value").alias("_t"), "place")
    shown = []
    section = F.when(has_text("section"), F.col("section"))
    table_line = F.concat(
        F.lit("**"), F.coalesce("act", F.lit("")), F.lit("**"), F.when(is_act, "").otherwise(" _(instrument)_"), F.lit(" "),
        F.coalesce(F.concat(F.lit("s "), section), F.lit("")), F.lit(" — "), F.coalesce("heading", F.lit("")), F.lit("\n\n"), F.col("content"), F.lit("\n"),
    )
    cells = [
        F.left(F.replace(F.coalesce("act", F.lit("")), F.lit("|"), F.lit("\\|")), F.lit(NAME_CELL)),
        F.when(is_act, "Act").otherwise("instrument"),
        F.coalesce(section, F.lit("-")),
        F.col("kind"),
        F.left(F.array_join(F.coalesce("amounts", F.array().cast("array<string>")), ", "), F.lit(AMOUNTS_CELL)),
        cell(F.col("content"), CONTENT_CELL),
    ]
    provision_line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    for part, mine, k, line, more in (
        (1, F.col("kind") == "table", TABLES_SHOWN, table_line, "_%d further tables in rates.jsonl._"),
        (3, F.col("kind") != "table", PROVISIONS_SHOWN, provision_line, "_%d further provisions in rates.jsonl._"),
    ):
        top = top_per_group(records.where(mine), "topic", [position], k)
        shown.append(top.select("topic", F.lit(part).alias("part"), F.col("rank").alias("at"), line.alias("line")))
        left = top.where((F.col("rank") == k) & (F.col("remainder") > 0))
        shown.append(left.select("topic", F.lit(part + 1).alias("part"), lit(0).alias("at"), F.format_string(more, "remainder").alias("line")))
    for s in shown:
        out = out.unionByName(s.join(place, F.col("topic") == F.col("_t")).select(F.lit(4).alias("block"), "place", "part", "at", "line"))
    return out


def write_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """The lines in order as text files whose names sort like the lines; no task holds the whole."""
    spark = lines.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines.repartitionByRange(n, *order).sortWithinPartitions(*order).select("line").write.mode("errorifexists").text(path)
