"""Provenance, counts, indexes, reports, lookups and gates."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tabularium.operators import contract, privacy, publication, relational
from tabularium.sources import files

TITLE = (
    "register_id string, name string, long_title string, collection string, compilation_number string, compilation_date date, version_is_current boolean, "
    "current_version_start date, source_url string, register_page string, retrieved date, markdown string, endnotes_text string"
)
DAY = dt.date(2026, 1, 2)


@pytest.mark.parametrize("text", ["plain", 'a "b" \\ c', "é – ‑", "\U0001d41a x", "tab\tline\n", ""])
def test_quoting_is_that_of_json(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(publication.quoted(F.col("t"))).first()[0] == json.dumps(text)


def test_provenance(spark):
    rows = [("C1", "A | “tax”", None, "Act", None, None, False, DAY, None, "https://r.example", DAY, "# A", "Note"), ("C2", "B", "L", None, "3", DAY, None, None, "u", "r", DAY, None, "")]
    got = {r.path: r.content for r in publication.title_documents(spark.createDataFrame(rows, TITLE)).collect()}
    assert set(got) == {"markdown/C1/C1.md", "markdown/C1/endnotes.md", "markdown/C2/C2.md"}
    a = got["markdown/C1/C1.md"]
    assert a.startswith('---\nregister_id: C1\ntitle: "A | \\u201ctax\\u201d"\nlong_title: ""\ncollection: Act\ncompilation_number: null\ncompilation_date: None\nversion_is_current: false\nsuperseded_from: 2026-01-02\n')
    assert a.endswith("---\n# A\n") and "at 2026-01-02. For the latest" in a
    assert got["markdown/C1/endnotes.md"].endswith("# Endnotes: A | “tax”\n\nNote\n") and "long_title" not in got["markdown/C1/endnotes.md"]
    assert "version_is_current: true\nsuperseded_from: null" in got["markdown/C2/C2.md"]
    assert spark.range(1).select(publication.attribution(F.lit(None).cast("date"))).first()[0] is None


def test_number_lines_show_what_they_leave_out(spark):
    rows = [(f"C{i % 3}", "An | Act", "Act" if i % 2 else None, str(i), None, "t1" if i < 150 else "t2", "table" if i % 3 == 0 else "rate", None if i % 3 == 0 else ["5%"], f"x {i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "register_id string, act string, collection string, section string, heading string, topic string, kind string, amounts array<string>, content string, at_ bigint")
    got = sorted((r.block, r.place, r.part, r["at"], r.line) for r in publication.number_lines(df, "at_").collect())
    assert got[0][4] == "200 entries across 3 titles."
    assert [x[4] for x in got if x[0] == 1] == ["| rate | 133 |", "| table | 67 |"] and [x[4] for x in got if x[0] == 3] == ["| t1 | 150 |", "| t2 | 50 |"]
    assert [x[4] for x in got if x[0] == 4 and x[2] == 2] == ["_10 further tables in rates.jsonl._"]
    assert len([x for x in got if x[0] == 4 and x[1] == 1 and x[2] == 3]) == 100 and not [x for x in got if x[2] == 4]
    assert [x[4] for x in got if x[2] == 3][0] == "| An \\| Act | Act | 1 | rate | 5% | x 1 |"
    assert [x[4] for x in got if x[2] == 1][0].startswith("**An | Act** s 0 — \n\nx 0")
    empty = publication.number_lines(df.limit(0), "at_").collect()
    assert [r.line for r in empty] == ["0 entries across 0 titles."]


def test_counts_and_index_of_odd_rows(spark):
    titles = spark.createDataFrame([("C1", "a", "Act", None, None, None, None, "m"), ("C2", "b", None, [], "whole_act", "e", False, "m")],
        "register_id string, name string, collection string, keywords_in_name array<string>, granularity string, endnotes string, version_is_current boolean, markdown string")
    rows = spark.createDataFrame([("C1", None, "1", "", "a b"), ("C1", "", None, None, None), ("C2", None, None, "container", "c"), ("C9", None, None, "introductory", "d"), (None, "Act", "", "", "")],
        "register_id string, collection string, section string, kind string, text string")
    got = {r.name: r.value for r in publication.counts_block(titles, rows, titles.limit(0)).collect()}
    assert (got["titles"], got["acts"], got["instruments"], got["jsonl_rows"], got["words_body_only"]) == (2, 1, 1, 5, 4)
    assert (got["rows_container"], got["rows_unnumbered"], got["rows_introductory"], got["rows_with_section_id"]) == (1, 2, 1, 1)
    assert (got["titles_no_keyword_in_current_name"], got["titles_not_current_version"], got["by_collection.Act.rows"], got["by_collection.unknown.rows"]) == (2, 1, 3, 2)
    t = titles.withColumns({"compilation_number": F.lit(None).cast("string"), "compilation_date": F.lit(None).cast("date"), "words": F.lit(1)})
    lines = publication.index_lines(t, spark.createDataFrame([("C1", 1234, 5)], "register_id string, rows bigint, words bigint")).orderBy("block", "place").collect()
    assert [r.line for r in lines] == ["| Acts | 1 | 1,234 | 5 |", "| Other collections | 1 | 0 | 0 |", "| [a](m) | C1 | - | - | 1,234 | 5 |", "| [b](m) | C2 | - | - | 0 | 0 |"]


def test_contact_reports(spark):
    c = spark.createDataFrame([("C1", "r1", "email", "s1"), ("C1", "r2", "email", "s1"), ("C2", "r3", "email", "s1"), ("C1", "r1", "tfn", "s2")] + [("C3", f"r{i}", "phone", f"p{i}") for i in range(9)],
        "register_id string, row_id string, kind string, sha256 string")
    allow = spark.createDataFrame([("email", "s1", "C1"), ("tfn", "s2", "C1")], "kind string, sha256 string, register_id string")
    got = {r.kind: (r.found, r.unapproved, r.different, r.approved, r.titles) for r in privacy.contact_report(c, allow).collect()}
    assert got == {"email": (3, 1, 1, 1, 2), "tfn": (1, 1, 1, 0, 1), "phone": (9, 9, 9, 0, 1)}
    shown = privacy.contact_examples(c, allow).collect()
    assert sorted((r.kind, r.row_id) for r in shown) == [("email", "r3"), *[("phone", f"r{i}") for i in range(5)], ("tfn", "r1")]


def snapshots(spark):
    d = [dt.date(2026, m, 1) for m in (1, 2, 3)]
    rows = [
        ("a", d[0], "A", 1, "x", 5), ("a", d[1], " a", 1, "x", 5), ("a", d[2], "A", 1, "x", 5), ("b", d[0], "B", 1, "x", 6), ("b", d[1], "B", 2, None, 6), ("b", d[2], "B", 2, None, 6),
        ("c", d[0], "C", 1, "x", 7), ("c", d[1], "Other", 1, "x", 7), ("c", d[2], "Other", 3, "y", 8), ("d", d[0], "D", 1, None, 1), ("e", d[0], "E", 1, None, 1), ("f", d[0], "F", 1, "x", 2), ("f", d[1], "F", None, "x", 2),
    ]
    return spark.createDataFrame(rows, "k string, at date, name string, n int, doc string, size int"), d


def test_lookups_over_snapshots(spark):
    s, d = snapshots(spark)
    known = spark.createDataFrame([("d",), ("f",), (None,)], "id string")
    got = {(r.k, str(r["at"])[5:7]): r.state for r in relational.lookup_states(s, known, "k", "id", "at", ["n"], "name", "doc").collect()}
    assert got == {
        ("a", "02"): "unchanged", ("a", "03"): "unchanged", ("b", "02"): "no-document", ("b", "03"): "unchanged", ("c", "02"): "error", ("c", "03"): "superseded",
        ("d", "02"): "gone", ("e", "02"): "error", ("f", "02"): "error", ("f", "03"): "gone",
    }
    listed = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "k string")
    assert {r.k: (r.status, r.size) for r in relational.document_statuses(listed, s, "k", "at", "doc", ["n"], "size").collect()} == {"a": ("cached", 5), "b": ("no_epub", 6), "c": ("ok", 8), "z": ("error", None)}
    assert [(r.k, r["at"], r.doc) for r in relational.recoverable(s, "k", "at", "doc").collect()] == [("b", d[0], "x")]
    assert {(r.k, r["at"], r.n) for r in relational.last_value_first_place(s, "k", "at", ["n"]).collect()} >= {("b", d[0], 2), ("c", d[0], 3), ("f", d[0], None)}
    for f in (lambda x: relational.lookup_states(x, known, "k", "id", "at", ["n"], "name", "doc"), lambda x: relational.recoverable(x, "k", "at", "doc")):
        assert f(s.limit(0)).count() == 0


def test_gates(spark):
    s, _ = snapshots(spark)
    relational.require_found(s, "k", s, "k", "fine")
    with pytest.raises(relational.GateError, match="unresolved.*'a'"):
        relational.require_found(s.where("k < 'c'"), "k", s.where("k = 'b'"), "k", "unresolved")
    relational.require_some(s, "fine")
    with pytest.raises(relational.GateError, match="nothing"):
        relational.require_some(s.limit(0), "nothing")


@pytest.mark.parametrize("change,rules", [({}, set()), ({"corpus": " "}, {"corpus"}), ({"retrieved": "2026-02-30"}, {"retrieved"}), ({"source": "Other"}, {"source"}), ({"source_api": "http://x"}, {"source_api"}), ({"source": None}, {"source"})])
def test_contract_header(spark, change, rules):
    good = {"corpus": "c", "retrieved": "2026-01-01", "source": contract.SOURCE, "source_api": "https://api.example/v1/"}
    h = spark.createDataFrame([tuple((good | change).values())], "corpus string, retrieved string, source string, source_api string")
    assert {r.rule for r in contract.header_violations(h, spark.range(1)).collect()} == rules
    assert {r.rule for r in contract.header_violations(h.drop("source"), spark.range(0)).collect()} == rules | {"source", "titles"}
    assert {r.rule for r in contract.header_violations(h.limit(0), spark.range(1)).collect()} == {"one header"}


def test_dates_of_retrieval(spark):
    a = spark.createDataFrame([(DAY,)], "modified date")
    assert files.with_retrieved(a).first().retrieved == DAY and files.with_retrieved(a, "2025-12-31").first().retrieved == dt.date(2025, 12, 31)
    with pytest.raises(ValueError):
        files.with_retrieved(a, "2025-13-01")


def test_write_lines(spark, tmp_path):
    df = spark.range(500).selectExpr("id % 50 AS a", "id AS b", "concat(id % 50, ' ', id) AS line").repartition(6)
    publication.write_lines(df, str(tmp_path / "x"), ["a", "b"])
    got = [line for f in sorted((tmp_path / "x").glob("part-*")) for line in f.read_text().splitlines()]
    assert got == [r.line for r in df.orderBy("a", "b").collect()]


VERSIONS = "titleId string, start date, isCurrent boolean, compilationNumber string, registerId string"


def test_versions_are_resolved_or_nothing_is(spark):
    from tabularium.operators import runs

    d = [dt.date(2026, m, 1) for m in (1, 2, 3)]
    v = spark.createDataFrame([("a", d[0], False, "1", "D1"), ("a", d[1], True, "2", None), ("b", d[2], True, None, "D9"), (None, d[0], True, "1", "D")], VERSIONS)
    t = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, name string")
    assert {(r.id, r.compilationNumber, r.compilationRegisterId) for r in runs.resolve_versions(t, v).collect()} == {("a", "2", None), ("b", None, "D9")}
    with pytest.raises(relational.GateError, match="'c'"):
        runs.resolve_versions(t.union(spark.createDataFrame([("c", "C")], t.schema)), v)
    looked = spark.createDataFrame([("a", True), ("b", True)], "id string, ok boolean")
    found = runs.latest_documents(looked, v)
    assert {(r.titleId, r.n_versions, r.registerId) for r in found.collect()} == {("a", 2, "D1"), ("b", 1, "D9")}
    for bad in (("x", True), ("a", False), ("a", None)):
        with pytest.raises(relational.GateError, match=bad[0]):
            runs.latest_documents(spark.createDataFrame([bad], looked.schema), v)
    manifest = spark.createDataFrame([("a", None), ("b", "b.epub"), ("z", None)], "id string, epub string")
    assert [(r.id, r.latest_document) for r in runs.recovered(manifest, found).collect()] == [("a", "D1")]


def test_a_corpus_is_published_whole_or_not_at_all(spark, tmp_path):
    from tabularium.operators import runs
    from tabularium.sources.publish import current

    columns = "register_id string, name string, collection string, compilation_number string, compilation_date date, register_page string, keywords_in_name array<string>, endnotes string, version_is_current boolean"
    t = spark.createDataFrame([("C2000A00001", "A Tax Act", "Act", "1", DAY, "p", ["Tax"], None, True), ("F2000L00002", "Rules", "LegislativeInstrument", None, None, None, None, None, False)], columns)
    html = '<p class="ActHead5"><span class="CharSectno">1 Rate</span></p><p class="subsection">The rate of tax is 5% of income.</p>'
    docs = spark.createDataFrame([("C2000A00001", html), ("F2000L00002", "<p>only prose</p>")], "register_id string, html string")
    root = str(tmp_path / "out")
    folder = runs.publish_corpus(spark, root, t, docs, "html")
    assert current(spark, root) == folder
    rows = spark.read.parquet(f"{folder}/sections").collect()
    assert {(r.row_id, r.kind) for r in rows} == {("C2000A00001:0001:1", "section"), ("F2000L00002:0001:-", "whole_act")}
    assert [(r.rate_id, r.kind) for r in spark.read.parquet(f"{folder}/numbers").collect()] == [("R00001", "rate")]
    assert {r.name: r.value for r in spark.read.parquet(f"{folder}/counts").collect()}["titles_whole_act_chunk"] == 1
    for bad in (t.limit(0), t.union(t.limit(1).withColumn("register_id", F.lit("C9")))):
        with pytest.raises(relational.GateError):
            runs.publish_corpus(spark, root, bad, docs, "html")
    broken = spark.createDataFrame([("C2000A00001", bytearray(b"PK")), ("F2000L00002", bytearray(b"no"))], "register_id string, z binary")
    with pytest.raises(relational.GateError, match="cannot be read"):
        runs.publish_corpus(spark, root, t, broken, "z")
    assert current(spark, root) == folder
