"""Readers, publication, contracts, checks (one planted violation each), stream, registry."""

import base64
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tabularium import schemas
from tabularium.operators import contract, publication, verify
from tabularium.operators.relational import GateError
from tabularium.sources import files, publish
from tabularium.sources.paged import read_paged
from tabularium.streaming.ingest import fresh_rows, latest_updates, publish_batches, publish_updates, stream_table, windowed_counts

RID, RID2 = "C2004A05138", "F2020L00001"


def test_manifest_and_tree(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"id": RID, "year": 2004}]))
    assert files.read_manifest(spark, str(tmp_path / "m.json"), schemas.TITLES).collect()[0]["year"] == 2004
    for folder, lines in ((RID, ['{"register_id": "%s", "row_id": "a", "text": "t"}' % RID, "", "{bad"]), ("odd", ['{"row_id": "b"}'])):
        (tmp_path / "md" / folder).mkdir(parents=True)
        (tmp_path / "md" / folder / "sections.jsonl").write_text("\n".join(lines))
    got = files.read_sections_tree(spark, str(tmp_path / "md")).collect()
    assert sorted((r.folder_id, r.folder_ok, r.row_id, r.bad_line is not None) for r in got if r.row_id) == [(RID, True, "a", False), ("odd", False, "b", False)]
    assert [r.bad_line for r in got if r.bad_line] == ["{bad"]


def test_envelopes_and_text_problems(spark, tmp_path):
    rows = [(1, bytearray(b"PK..")), (2, bytearray(json.dumps({"bytes": base64.b64encode(b"PK").decode()}).encode())), (3, bytearray(b'{"bytes": "!!"}')), (4, bytearray(b"\xff\xfe")), (5, None)]
    got = {r.i: r.c for r in files.decode_envelope(spark.createDataFrame(rows, "i int, c binary"), "c").collect()}
    assert got[1] == b"PK.." and got[2] == b"PK" and got[3] is None and got[4] is None and got[5] is None
    for name, content in (("a.md", b"fine\t\n"), ("b.md", b"\xff"), ("c.md", b"a\x01")):
        (tmp_path / name).write_bytes(content)
    assert sorted((os.path.basename(r.path), r.problem) for r in files.text_problems(spark, str(tmp_path / "*.md")).collect()) == [("b.md", "not UTF-8"), ("c.md", "control characters")]


def test_cache_listing_and_paths(spark, tmp_path):
    r = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "id string, versionStart string")
    s = spark.createDataFrame([("a", "1", True), ("b", "1", True), ("c", "3", False)], "id string, versionStart string, valid boolean")
    assert {x.id: x.cached for x in files.cached_unchanged(r, s).collect()} == {"a": True, "b": False, "c": False}
    (tmp_path / ".hidden").write_text("x")
    (tmp_path / "d").mkdir()
    os.symlink("/etc", tmp_path / "link")
    assert {(x.path, x.kind) for x in files.listing(spark, str(tmp_path)).collect()} == {(".hidden", "file"), ("d", "dir"), ("link", "symlink")}
    assert files.contained(str(tmp_path), "d", "f").endswith("/d/f")
    for bad in (("..", "x"), ("link", "passwd"), ("/etc/passwd",)):
        with pytest.raises(GateError):
            files.contained(str(tmp_path), *bad)


def entry(**change):
    return {"kind": "email", "sha256": "0" * 64, "register_id": RID, "reason": "public office"} | change


@pytest.mark.parametrize("bad", [entry(kind="tfn"), entry(sha256="x"), entry(register_id="q"), entry(reason=" "), entry(reason="call a@b.example"), {**entry(), "more": "x"}, entry(reason=None)])
def test_bad_allowlists(bad):
    assert files.allowlist_problems([bad]) and not files.allowlist_problems([entry()]) and files.allowlist_problems([entry(), entry()])


def test_allowlist_file(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text(json.dumps({"schema_version": 1, "entries": [entry()]}))
    assert files.read_allowlist(spark, str(p)).count() == 1
    for text in ('{"schema_version": 2, "entries": []}', '{"schema_version": 1, "schema_version": 1, "entries": []}', '{"schema_version": 1, "entries": [{"a": {"b": 1, "b": 2}}]}', "[]"):
        p.write_text(text)
        with pytest.raises(GateError):
            files.read_allowlist(spark, str(p))


def pages(root, collection, keyword, *sizes):
    folder = root / collection / keyword
    folder.mkdir(parents=True)
    n = 0
    for i, size in enumerate(sizes):
        (folder / f"{i:03d}.json").write_text(json.dumps({"value": [{"id": f"{collection}{keyword}{n + k}", "collection": collection} for k in range(size)]}))
        n += size


def test_paged_source(spark, tmp_path):
    pages(tmp_path, "Act", "Tax", 100, 3)
    pages(tmp_path, "Act", "Excise", 0)
    pages(tmp_path, "Other", "Tax", 5)
    df = read_paged(spark, str(tmp_path))
    assert df.count() == 108 and df.where("collection = 'Other'").count() == 5
    pages(tmp_path, "Bad", "Tax", 3, 4)
    with pytest.raises(Exception, match="incomplete scan"):
        read_paged(spark, str(tmp_path)).count()


def test_publication(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    fine = lambda t: t["x"].select(F.lit("n").alias("label"), (F.col("n") == 1).alias("ok"), F.lit("").alias("detail"))
    first = publish.publish(spark, root, {"x": df}, fine, {"README": "hi\n"})
    assert publish.current(spark, root) == first and os.path.exists(first + "/README")
    with pytest.raises(GateError, match="n"):
        publish.publish(spark, root, {"x": df.withColumn("n", F.lit(2))}, fine)
    assert publish.current(spark, root) == first and sorted(x for x in os.listdir(root) if not x.startswith(".")) == sorted([publish.POINTER, os.path.basename(first)])
    with pytest.raises(Exception):
        publish.publish(spark, root, {"x": df, "y": df.select(F.raise_error(F.lit("no")))}, fine)
    assert publish.current(spark, root) == first and not os.path.exists(os.path.join(root, publish.LOCK))
    assert publish.publish(spark, root, {"x": df}, fine) == publish.current(spark, root) != first
    many = spark.range(200).selectExpr("if(id % 4 = 0, 'b', 'a') AS id", "format_string('%04d', id) AS row_id").repartition(7)
    publish.export_jsonl(many, str(tmp_path / "json"), "id")
    for value, n in (("a", 150), ("b", 50)):
        folder = tmp_path / "json" / f"id={value}"
        got = [line for f in sorted(os.listdir(folder)) if f.endswith(".json") for line in (folder / f).read_text().splitlines()]
        assert len(got) == n and got == sorted(got)
    publish.write_atomic(spark, f"{root}/{publish.POINTER}", "../etc")
    with pytest.raises(GateError):
        publish.current(spark, root)


def test_writer_lock(spark, tmp_path):
    root, order = str(tmp_path), []

    def second():
        with publish.writer_lock(spark, root, 10):
            order.append("second")

    with publish.writer_lock(spark, root):
        t = threading.Thread(target=second)
        t.start()
        time.sleep(0.3)
        order.append("first")
    t.join()
    assert order == ["first", "second"]
    with pytest.raises(publish.RollbackError), publish.writer_lock(spark, root, 1):
        raise publish.RollbackError("stays")
    assert (tmp_path / publish.LOCK).exists()
    with pytest.raises(GateError), publish.writer_lock(spark, root, 0.2):
        pass
    assert publish.canonical_json({"b": 1, "a": "é"}) == '{\n  "a": "é",\n  "b": 1\n}\n'


BASE = (RID, "Act", "Act", "3", "2020-01-01", True, None, "2026-01-01", "https://a.example/x", "https://a.example:443/y?z#q")


def base(spark, *changes):
    names = contract.BASELINE
    rows = [tuple((dict(zip(names, BASE)) | c)[n] for n in names) for c in ({}, *changes)]
    return spark.createDataFrame(rows, schemas.BASELINE)


@pytest.mark.parametrize("change,rule", [
    ({"name": " "}, "name"), ({"name": "a\x07"}, "name"), ({"collection": "Other"}, "collection"), ({"compilation_number": None}, "compilation_number"),
    ({"compilation_date": "2020-02-30"}, "compilation_date"), ({"version_is_current": None}, "version_is_current"), ({"version_is_current": False}, "current_version_start"),
    ({"retrieved": "20260101"}, "retrieved"), ({"source_url": "http://a.example"}, "source_url"), ({"source_url": "https://u:p@a.example"}, "source_url"),
    ({"source_url": "https://a.example:99999/"}, "source_url"), ({"register_page": "https://a b.example"}, "register_page"), ({"register_page": "https://a.example\\b"}, "register_page")])
def test_baseline_rules(spark, change, rule):
    got = contract.baseline_violations(base(spark, {"register_id": RID2} | change)).collect()
    assert rule in {r.rule for r in got} and {r.register_id for r in got} == {RID2}


def test_baseline(spark):
    assert contract.baseline_violations(base(spark)).count() == 0
    assert [r.rule for r in contract.baseline_violations(base(spark, {})).collect()] == ["unique register_id"]
    assert contract.baseline(base(spark).withColumn("more", F.lit(1))).columns == contract.BASELINE


OBS = dict(register_id=RID, collection="Act", state="UNCHANGED", observed_compilation_number=None, observed_compilation_date=None, observed_register_document_id=None,
           current_version_start=None, evidence_url="https://a.example", checked_at="2026-01-01T00:00:00Z", error_category=None, evidence_id="e1")


def obs(spark, *items):
    names = [f.split()[0] for f in schemas.OBSERVATION.split(", ")]
    return spark.createDataFrame([tuple((OBS | i)[n] for n in names) for i in items], schemas.OBSERVATION)


@pytest.mark.parametrize("change,rule", [
    ({"register_id": "X"}, "in scope"), ({"collection": "Other"}, "collection"), ({"state": "ODD"}, "state"), ({"state": None}, "state"), ({"error_category": "x"}, "error_category"),
    ({"state": "SUPERSEDED"}, "observed_compilation_number"), ({"state": "LOOKUP_FAILED"}, "error_category"), ({"state": "CURRENT_NO_PUBLISHED_COMPILATION"}, "current_version_start"),
    ({"checked_at": "2026-01-01T00:00:00"}, "checked_at"), ({"evidence_url": None}, "evidence_url"), ({"evidence_id": ""}, "evidence_id")])
def test_observation_rules(spark, change, rule):
    assert rule in {r.rule for r in contract.observation_violations(obs(spark, change), base(spark), complete=False, v2=True).collect()}


def test_observations(spark):
    b = base(spark, {"register_id": RID2})
    good = obs(spark, {}, {"register_id": RID2, "evidence_id": "e2", "state": "LOOKUP_FAILED", "error_category": "timeout"})
    assert contract.observation_violations(good, b, complete=True, v2=True).count() == 0
    assert [r.rule for r in contract.observation_violations(good.limit(1), b, complete=True).collect()] == ["covered"]
    assert contract.observation_violations(good.limit(1), b, complete=False).count() == 0
    same = obs(spark, {}, {"register_id": RID2})
    assert {r.rule for r in contract.observation_violations(same, b, complete=True, v2=True).collect()} == {"unique evidence_id"}
    assert "evidence_id" not in contract.observation(good).columns and contract.observation(good, v2=True).count() == 2


SECT = "register_id string, row_id string, collection string, section string, kind string, text string, folder_id string, bad_line string"
TITLE = "register_id string, collection string, epub string, markdown string, sections_jsonl string, endnotes string, name string, keywords_in_name array<string>, granularity string, version_is_current boolean"


def title(rid, collection="Act", epub=None, endnotes=None):
    return (rid, collection, epub, f"markdown/{rid}/{rid}.md", f"markdown/{rid}/sections.jsonl", endnotes, "A tax", ["Tax"], "section", True)


def section(rid, n, text, collection="Act", label="1", kind="section", folder=None, bad=None):
    return (rid, f"{rid}:{n:04d}:{label or '-'}", collection, label, kind, text, folder or rid, bad)


def title_files(rid):
    return [(f"markdown/{rid}", "dir", None), (f"markdown/{rid}/{rid}.md", "file", 1), (f"markdown/{rid}/sections.jsonl", "file", 1)]


def parts(spark):
    """A version that holds: two titles, three rows, one number, one title left out."""
    titles = spark.createDataFrame([title(RID), title(RID2, "NotifiableInstrument")], TITLE)
    rows = spark.createDataFrame([section(RID, 1, "The rate is 5%."), section(RID2, 1, "Nothing here.", None, None, ""), section(RID2, 2, "More", None, None, "container")], SECT)
    counts = publication.counts_block(titles, rows, titles.limit(0))
    said = [
        ("INDEX.md", "2 titles (1 Acts, 1 instruments), 3 retrieval rows, 7 words."), ("README.md", "1 Acts and 1 legislative and notifiable instruments"),
        ("README.md", "2 in-force principal titles"), ("README.md", "3 retrieval rows, 7 words."), ("REMOVED.md", "| [F1999N00001](x) |"),
        ("rates/RATES.md", "1 entries across 1 titles."), ("rates/RATES.md", "The rate is 5%."),
    ]
    return {
        "titles": titles,
        "sections": rows,
        "numbers": spark.createDataFrame([(RID, "The rate is 5%.")], "register_id string, content string"),
        "removed": spark.createDataFrame([("F1999N00001", "List of Agents")], "register_id string, name string"),
        "allowlist": spark.createDataFrame([], "kind string, sha256 string, register_id string"),
        "counts": spark.createDataFrame(counts.collect(), counts.schema),
        "lines": spark.createDataFrame(said, "path string, line string"),
        "files": spark.createDataFrame([*title_files(RID), *title_files(RID2), ("INDEX.md", "file", 1)], "path string, kind string, bytes bigint"),
    }


def failed(p):
    return {r.label for r in verify.checks(verify.Published(**p)).where("NOT ok").collect()}


def test_checks_hold_and_take_empty_tables(spark):
    p = parts(spark)
    got = verify.checks(verify.Published(**p)).collect()
    assert len(got) == 36 and all(r.ok and r.detail == "0" for r in got)
    assert len(verify.checks(verify.Published(**{k: v.limit(0) for k, v in p.items()})).collect()) == 36


NEW = "F2000L00009"


@pytest.mark.parametrize("table,row,labels", [
    ("titles", title(NEW), ["every listed title has a directory", "title file inventory matches declared outputs", "sources count: titles", "sources count: acts and instruments", "sources collection counts"]),
    ("files", (f"markdown/{NEW}", "dir", None), ["no directory beyond what is listed"]),
    ("files", ("markdown/notes.md", "file", 1), ["no directory beyond what is listed"]),
    ("files", ("markdown/F1999N00001", "dir", None), ["no removed title present"]),
    ("files", (f"markdown/{RID}/more", "symlink", None), ["title files stay inside real link-free directories"]),
    ("files", (f"markdown/{RID}/more.md", "file", 1), ["title file inventory matches declared outputs"]),
    ("files", ("img/arms.PNG", "file", 1), ["no image files"]),
    ("sections", section(RID, 2, None, bad="{"), ["every JSONL row parses", "sources count: rows"]),
    ("sections", section(RID, 2, "x", folder=RID2), ["each JSONL row matches its title directory"]),
    ("sections", section(RID, 2, "a\x01"), ["all distributed title files are validated UTF-8 text"]),
    ("sections", section(RID, 2, "Wilma Obermoor 12345678"), ["no title file names private individuals", "no row names private individuals", "sources count: words", "sources count: section rows"]),
    ("sections", section(RID, 2, "a@b.example"), ["no unapproved contact identifiers"]),
    ("sections", section(RID, 2, "x", label=None, kind="container"), ["sources count: tracked row kinds"]),
    ("sections", section(RID, 1, "x"), ["row ids are unique"]),
    ("sections", (RID, f"{RID2}:0009:-", "Act", None, "", "x", RID, None), ["row id belongs to its title"]),
    ("titles", title(RID), ["titles are unique"]),
    ("titles", title(NEW, epub="x.epub"), ["title metadata does not point to excluded EPUBs"]),
    ("counts", ("epub_bytes", 5), ["sources declares no distributed EPUB bytes"]),
    ("counts", ("titles", 900), ["INDEX headline matches generated counts", "README states the real title count"]),
    ("counts", ("acts", 900), ["README headline matches generated counts"]),
    ("lines", ("INDEX.md", "| [x](markdown/F1999N00001) |"), ["INDEX links no removed title"]),
    ("lines", ("README.md", "see epub/<register_id>.epub"), ["README does not promise EPUB files"]),
    ("lines", ("README.md", "three titles name people"), ["README does not claim rows naming people"]),
    ("removed", ("F1999N00002", "Other"), ["REMOVED.md lists every exclusion"]),
    ("numbers", (None, "x"), ["every rates JSONL row parses", "RATES headline matches filtered JSONL"]),
    ("numbers", ("F1999N00001", "x"), ["no rates entry cites a removed title", "every rates entry cites a present title"]),
    ("lines", ("rates/RATES.md", "as in List of Agents"), ["RATES contains no removed-title name"])])
def test_each_check_finds_its_violation(spark, table, row, labels):
    p = parts(spark)
    p |= {table: p[table].union(spark.createDataFrame([row], p[table].schema))}
    assert set(labels) <= failed(p)


def test_streams(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "k string, ts timestamp"
    import datetime as dt

    day = dt.datetime(2026, 1, 1)
    rows = [("a", day), ("a", day), ("b", day + dt.timedelta(hours=3)), ("c", day + dt.timedelta(days=1))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    q = publish_batches(fresh_rows(stream_table(spark, src, schema), "k", "ts", "1 day"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
    q = publish_updates(windowed_counts(stream_table(spark, src, schema), "ts", "k", "1 day", "1 hour"), str(tmp_path / "w"), str(tmp_path / "wcp"))
    q.awaitTermination()
    assert sorted((r.k, r.n) for r in latest_updates(spark, str(tmp_path / "w"), ["start", "k"]).collect()) == [("a", 2), ("b", 1), ("c", 1)]


def test_registry():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and {f"p{n}_found" for n in (5, 6)} <= set(q) and len(q) >= 40
