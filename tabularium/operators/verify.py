"""Checks of what is published, as a table (label, ok, detail).

Every text is scanned once for the row checks and once for contacts; all
checks follow from small tables of counts. detail is how many violations a
check found, never what they say.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions import identifiers as I  # noqa: E741
from tabularium.functions.text import thousands_text, word_count
from tabularium.operators import privacy
from tabularium.operators.relational import duplicate_keys, lines_with
from tabularium.operators.rollup import has_text, kind_or_default
from tabularium.session import materialise

# What may not be shipped, and what a title's folder holds.
IMAGE_TYPES = ["png", "jpg", "jpeg", "gif", "svg", "epub"]
TITLE_FILES = {"markdown": "markdown/%1$s/%1$s.md", "sections_jsonl": "markdown/%1$s/sections.jsonl", "endnotes": "markdown/%1$s/endnotes.md"}
ROW_KINDS = ["container", "unnumbered", "introductory"]


@dataclass
class Published:
    """The tables of one published version.

    titles: register_id, collection, epub, markdown, sections_jsonl, endnotes;
    sections: row_id, register_id, collection, section, kind, text, and, if
    they were read from files, folder_id and bad_line; numbers: register_id,
    content, and bad_line likewise; removed: register_id, name; allowlist:
    kind, sha256, register_id; counts: name, value as in counts_block();
    lines: path, line of the readable files INDEX.md, README.md, REMOVED.md
    and rates/RATES.md; files: path, kind, bytes of everything there is.
    """

    titles: DataFrame
    sections: DataFrame
    numbers: DataFrame
    removed: DataFrame
    allowlist: DataFrame
    counts: DataFrame
    lines: DataFrame
    files: DataFrame


def _col(df: DataFrame, name: str, default) -> Column:
    return F.col(name) if name in df.columns else default


def _row_counts(p: Published) -> DataFrame:
    """Per (folder, collection of the row): what the row checks need, in one pass over the texts."""
    s = p.sections
    t = F.col("text")
    bad = _col(s, "bad_line", F.lit(None)).isNotNull() | t.isNull() | F.col("row_id").isNull()
    good = ~bad
    numbered = t.rlike(I.REGISTRATION)
    pair = good & numbered & F.when(numbered, F.size(I.person_names(t)) > 0)
    folder = _col(s, "folder_id", F.col("register_id"))
    kind = kind_or_default()
    return s.groupBy(folder.alias("folder"), "collection").agg(
        F.count("*").alias("rows"),
        F.count_if(bad).alias("bad"),
        F.count_if(good & ~F.col("register_id").eqNullSafe(folder)).alias("mismatch"),
        F.count_if(good & (~F.is_valid_utf8("text") | I.has_control_bytes(t))).alias("unreadable"),
        F.count_if(pair).alias("named"),
        F.count_if(good & ~F.coalesce(F.col("row_id").startswith(F.concat("register_id", F.lit(":"))), F.lit(False))).alias("foreign"),
        F.coalesce(F.sum(F.when(good, word_count(t))), F.lit(0)).alias("words"),
        F.count_if(good & has_text("section")).alias("section_rows"),
        *[F.count_if(good & (kind == k)).alias(f"kind_{k}") for k in ROW_KINDS],
    )


def checks(p: Published) -> DataFrame:
    """All checks; a label that is not ok may not be published."""
    rows = materialise(_row_counts(p))
    titles, removed = p.titles, p.removed.select("register_id", "name").distinct()
    file_id = F.regexp_extract("path", r"^markdown/([^/]+)", 1)
    shape = r"\A[A-Z]\d{4}[A-Z]\d{5}\z"

    # who is listed, present, removed and cited
    inside = p.files.where(F.col("path").startswith("markdown/") & (file_id != "")).select(
        file_id.alias("id"), ((F.col("path") == F.concat(F.lit("markdown/"), file_id)) & (F.col("kind") != "dir")).alias("stray"), (~F.col("kind").isin("dir", "file")).alias("link")
    )
    mark = lambda df, name: df.select(F.col("id"), *[(F.lit(name == n)).alias(n) for n in ("listed", "present", "removed", "cited")])
    ids = [
        mark(titles.select(F.col("register_id").alias("id")), "listed"),
        mark(inside.where("NOT stray").select("id"), "present"),
        mark(removed.select(F.col("register_id").alias("id")), "removed"),
        mark(p.numbers.select(F.col("register_id").alias("id")), "cited"),
    ]
    who = reduce(DataFrame.unionByName, ids).where("id IS NOT NULL").groupBy("id").agg(*[F.bool_or(c).alias(c) for c in ("listed", "present", "removed", "cited")])
    stray = inside.agg(F.count_if("stray").alias("stray"), F.count_if("link").alias("links"))

    def facts(df: DataFrame, **named: Column) -> DataFrame:
        one = df.agg(*[e.alias(n) for n, e in named.items()])
        return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("fact"), F.coalesce(F.col(n).cast("bigint"), F.lit(0)).alias("n")) for n in named])))

    is_act = F.col("collection") == "Act"
    total = lambda c: F.sum(c)
    parts = [
        facts(
            who,
            unlisted_dir=F.count_if(F.col("present") & ~F.col("listed")), missing_dir=F.count_if(F.col("listed") & ~F.col("present")),
            removed_there=F.count_if(F.col("removed") & F.col("present")), cites_removed=F.count_if(F.col("cited") & F.col("removed")),
            cites_absent=F.count_if(F.col("cited") & ~F.col("present")), odd_dir=F.count_if(F.col("present") & ~F.col("id").rlike(shape)),
        ),
        facts(stray, stray=F.sum("stray"), links=F.sum("links")),
        facts(
            rows,
            rows=total("rows"), bad=total("bad"), mismatch=total("mismatch"), unreadable=total("unreadable"), named=total("named"), foreign=total("foreign"),
            words=total("words"), section_rows=total("section_rows"), **{f"kind_{k}": total(f"kind_{k}") for k in ROW_KINDS},
        ),
        facts(titles, titles=F.count("*"), acts=F.count_if(is_act), with_epub=F.count_if(F.col("epub").isNotNull())),
        facts(p.numbers, numbers=F.count("*"), numbered=F.countDistinct("register_id"), bad_numbers=F.count_if(_col(p.numbers, "bad_line", F.lit(None)).isNotNull() | F.col("register_id").isNull())),
        facts(p.files, images=F.count_if(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(IMAGE_TYPES))),
        _fact(duplicate_keys(titles, ["register_id"]), "titles_twice"),
        _fact(duplicate_keys(p.sections.where("row_id IS NOT NULL"), ["row_id"]), "rows_twice"),
        _inventory(p),
        _contacts(p),
        _by_collection(p, rows),
        _declared(p),
        _said(p, removed),
    ]
    got = reduce(DataFrame.unionByName, parts)
    names = [
        "unlisted_dir", "missing_dir", "removed_there", "cites_removed", "cites_absent", "odd_dir", "stray", "links", "rows", "bad", "mismatch", "unreadable", "named", "foreign", "titles_twice", "rows_twice", "words",
        "section_rows", *[f"kind_{k}" for k in ROW_KINDS], "titles", "acts", "with_epub", "numbers", "numbered", "bad_numbers", "images", "files_differ", "unapproved", "collections_differ",
        "d_titles", "d_acts", "d_instruments", "d_rows", "d_words", "d_section_rows", *[f"d_{k}" for k in ROW_KINDS], "d_epub_bytes",
        "index_removed", "rates_named", "unlisted_removed", "promises_epub", "claims_people", "h_index", "h_titles", "h_acts", "h_rows", "h_rates",
    ]
    one = got.groupBy().agg(*[F.coalesce(F.max(F.when(F.col("fact") == n, F.col("n"))), F.lit(0)).alias(n) for n in names])
    c = F.col
    differ = lambda a, b: (c(a) != c(b)).cast("int")
    labels: dict[str, Column] = {
        "every listed title has a directory": c("missing_dir"),
        "no directory beyond what is listed": c("unlisted_dir") + c("stray") + c("odd_dir"),
        "no removed title present": c("removed_there"),
        "every JSONL row parses": c("bad"),
        "each JSONL row matches its title directory": c("mismatch"),
        "title files stay inside real link-free directories": c("links"),
        "title file inventory matches declared outputs": c("files_differ"),
        "all distributed title files are validated UTF-8 text": c("unreadable"),
        "no title file names private individuals": c("named"),
        "no row names private individuals": c("named"),
        "no unapproved contact identifiers": c("unapproved"),
        "sources count: titles": differ("d_titles", "titles"),
        "sources count: acts and instruments": ((c("d_acts") != c("acts")) | (c("d_instruments") != c("titles") - c("acts"))).cast("int"),
        "sources count: rows": differ("d_rows", "rows"),
        "sources count: words": differ("d_words", "words"),
        "sources count: section rows": differ("d_section_rows", "section_rows"),
        "sources count: tracked row kinds": reduce(Column.__add__, [differ(f"d_{k}", f"kind_{k}") for k in ROW_KINDS]),
        "sources collection counts": c("collections_differ"),
        "sources declares no distributed EPUB bytes": (c("d_epub_bytes") != 0).cast("int"),
        "title metadata does not point to excluded EPUBs": c("with_epub"),
        "no image files": c("images"),
        "INDEX links no removed title": c("index_removed"),
        "INDEX headline matches generated counts": 1 - c("h_index"),
        "README states the real title count": 1 - c("h_titles"),
        "README headline matches generated counts": 1 - F.least("h_acts", "h_rows"),
        "README does not promise EPUB files": c("promises_epub"),
        "README does not claim rows naming people": c("claims_people"),
        "REMOVED.md lists every exclusion": c("unlisted_removed"),
        "every rates JSONL row parses": c("bad_numbers"),
        "no rates entry cites a removed title": c("cites_removed"),
        "every rates entry cites a present title": c("cites_absent"),
        "RATES headline matches filtered JSONL": 1 - c("h_rates"),
        "RATES contains no removed-title name": c("rates_named"),
        "titles are unique": c("titles_twice"),
        "row ids are unique": c("rows_twice"),
        "row id belongs to its title": c("foreign"),
    }
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("label"), (v == 0).alias("ok"), v.cast("string").alias("detail")) for k, v in labels.items()])))


def _fact(df: DataFrame, fact: str) -> DataFrame:
    """(fact, n): how many rows a table has."""
    return df.agg(F.count("*").alias("n")).select(F.lit(fact).alias("fact"), "n")


def _inventory(p: Published) -> DataFrame:
    """Files of titles that are declared and not there, there and not declared, or declared under another path."""
    want = p.titles.select(
        F.inline(F.array(*[F.struct(F.col(c).alias("declared"), F.when(F.col(c).isNotNull() | F.lit(c != "endnotes"), F.format_string(f, "register_id")).alias("path")) for c, f in TITLE_FILES.items()]))
    )
    have = p.files.where((F.col("kind") == "file") & F.col("path").startswith("markdown/")).select(F.col("path").alias("have"))
    both = want.where("path IS NOT NULL").join(have, F.col("path") == F.col("have"), "full_outer")
    return _fact(both.where("path IS NULL OR have IS NULL OR NOT (declared <=> path)"), "files_differ")


def _contacts(p: Published) -> DataFrame:
    found = privacy.contact_fingerprints(p.sections, ["register_id"], "text").distinct()
    return _fact(privacy.unapproved(found, p.allowlist), "unapproved")


def _by_collection(p: Published, rows: DataFrame) -> DataFrame:
    """Announced and recounted totals of every collection that differ; a row without a collection counts to its title's."""
    t = p.titles.select(F.col("register_id").alias("_id"), F.col("collection").alias("_c"))
    named = rows.join(t, F.col("folder") == F.col("_id"), "left")
    coll = F.when(has_text("collection"), F.col("collection")).when(has_text("_c"), F.col("_c")).otherwise("unknown")
    sums = named.groupBy(coll.alias("c")).agg(F.sum("rows").alias("rows"), F.sum("words").alias("words"))
    of = p.titles.groupBy(F.coalesce("collection", F.lit("unknown")).alias("c")).agg(F.count("*").alias("titles")).join(sums, "c", "left")
    got = of.select(F.inline(F.array(*[F.struct(F.concat(F.lit("by_collection."), F.col("c"), F.lit(f".{k}")).alias("k"), F.coalesce(F.col(k), F.lit(0)).alias("v")) for k in ("titles", "rows", "words")])))
    said = p.counts.where(F.col("name").startswith("by_collection."))
    return _fact(got.join(said, F.col("k") == F.col("name"), "full_outer").where("NOT (v <=> value)"), "collections_differ")


def _declared(p: Published) -> DataFrame:
    names = {
        "titles": "titles", "acts": "acts", "instruments": "instruments", "jsonl_rows": "rows", "words_body_only": "words", "rows_with_section_id": "section_rows",
        **{f"rows_{k}": k for k in ROW_KINDS}, "epub_bytes": "epub_bytes",
    }
    known = p.counts.where(F.col("name").isin(list(names)))
    fact = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("name")]
    return known.select(F.concat(F.lit("d_"), fact).alias("fact"), F.col("value").cast("bigint").alias("n"))


def _said(p: Published, removed: DataFrame) -> DataFrame:
    """What the readable files say: headlines that are there (1), and what should not be."""
    value = lambda n: F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0)).cast("bigint")
    v = p.counts.agg(*[value(n).alias(n) for n in ("titles", "acts", "instruments", "jsonl_rows", "words_body_only")])
    rates = p.numbers.agg(F.count("*").alias("n"), F.countDistinct("register_id").alias("t"))
    rows_line = F.format_string("%s retrieval rows, %s words.", thousands_text(F.col("jsonl_rows")), thousands_text(F.col("words_body_only")))
    head = lambda fact, path, line: F.struct(F.lit(fact).alias("fact"), F.lit(path).alias("path"), line.alias("line"))
    index = F.concat(F.format_string("%s titles (%d Acts, %d instruments), ", thousands_text(F.col("titles")), "acts", "instruments"), rows_line)
    wanted = v.select(
        F.inline(
            F.array(
                head("h_index", "INDEX.md", index),
                head("h_titles", "README.md", F.format_string("%d in-force principal", "titles")),
                head("h_acts", "README.md", F.format_string("%d Acts and %d legislative and notifiable", "acts", "instruments")),
                head("h_rows", "README.md", rows_line),
            )
        )
    )
    entries = F.format_string("%s entries across %s titles.", thousands_text(F.col("n")), thousands_text(F.col("t")))
    wanted = wanted.unionByName(rates.select(F.inline(F.array(head("h_rates", "rates/RATES.md", entries)))))
    said = p.lines.select(F.col("path").alias("_path"), F.col("line").alias("_line"))
    # five headlines: the wanted side is five rows by construction
    there = said.join(F.broadcast(wanted), (F.col("_path") == F.col("path")) & F.contains("_line", "line")).select("fact", F.lit(1).cast("bigint").alias("n")).distinct()
    gone = removed.select(F.col("register_id").alias("needle"))
    of = lambda path: p.lines.where(F.col("path") == path)
    ids = F.explode(F.regexp_extract_all("line", F.lit(r"([A-Z]\d{4}[A-Z]\d{5})"), F.lit(1)))
    linked = of("INDEX.md").select(ids.alias("needle")).distinct().join(gone, "needle", "left_semi")
    listed = gone.join(of("REMOVED.md").select(ids.alias("needle")).distinct(), "needle", "left_anti")
    readme = of("README.md")
    return reduce(
        DataFrame.unionByName,
        [
            there,
            _fact(linked, "index_removed"),
            _fact(listed, "unlisted_removed"),
            _fact(lines_with(of("rates/RATES.md"), "line", removed.select("name")), "rates_named"),
            _fact(readme.where(F.col("line").contains("epub/<register_id>.epub")), "promises_epub"),
            _fact(readme.where(F.col("line").contains("titles name people") | F.col("line").contains("disciplined agents")), "claims_people"),
        ],
    )
