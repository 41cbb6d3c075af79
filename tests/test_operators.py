"""Snapshots, histories, relational and sequence operators, roll-ups, privacy."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tabularium.operators import numbers, privacy, relational, rollup, sequence
from tabularium.operators.history import attribute_history
from tabularium.operators.snapshots import numeric_text, snapshot_changes

SNAP = "id string, day date, loaded timestamp, num string, d date, extra string, _key string"
DAYS = [dt.date(2026, m, 5) for m in range(1, 8)]


def snapshots(seed):
    r = random.Random(seed)
    rows = []
    for day in DAYS:
        for k in range(30):
            if r.random() < 0.7:
                v = (r.choice([None, "1", "01", "2 ", "No. 2"]), r.choice([None, dt.date(2020, 1, 1), dt.date(2021, 1, 1)]))
                late = dt.datetime(2026, 9, 1, r.randrange(24))
                rows.append((f"k{k}", day, dt.datetime(2026, 8, 1), "9", None, "x", "y"))
                rows.append((f"k{k}", day, late, *v, "x", None))
                if r.random() < 0.2:
                    rows.append(rows[-1])
    return rows + [(None, DAYS[0], None, "1", None, None, None), ("k1", None, None, "1", None, None, None)]


def held(rows):
    out = {}
    for k, day, loaded, num, d, *_ in rows:
        if k and day and (loaded is not None and (k, day) not in out or loaded and loaded > out[k, day][0]):
            n = "".join(c for c in num or "" if c.isdigit())
            out[k, day] = (loaded, int(n) if n else None, d)
    return {k: v[1:] for k, v in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_against_brute_force(spark, seed):
    rows = snapshots(seed)
    df = spark.createDataFrame(rows, SNAP)
    got = {tuple(x) for x in snapshot_changes(df, "id", "day", "loaded", {"n": numeric_text(F.col("num")), "d": F.col("d")}).collect()}
    h = held(rows)
    want = set()
    for a, b in zip(DAYS, DAYS[1:]):
        for k in {k for k, _ in h}:
            x, y = h.get((k, a)), h.get((k, b))
            if x != y or (x is None) != (y is None):
                want.add((k, b, "added" if x is None else "removed" if y is None else "changed"))
    assert got == want


def test_kept_snapshots_grow_and_are_replaced(spark, tmp_path):
    rows = [r for r in snapshots(3) if r[1]]
    df = spark.createDataFrame(rows, SNAP)
    compare = {"n": numeric_text(F.col("num")), "d": F.col("d")}
    want = sorted(map(str, snapshot_changes(df, "id", "day", "loaded", compare).collect()))
    for root, n in ((str(tmp_path / "a"), 5), (f"file://{tmp_path}/b", 1)):
        snapshot_changes(df.where(F.col("day") <= F.lit(DAYS[2])), "id", "day", "loaded", compare, root, n)
        wrong = df.where(F.col("day") == F.lit(DAYS[3])).withColumn("num", F.lit("77"))
        snapshot_changes(wrong, "id", "day", "loaded", compare, root)
        grown = snapshot_changes(df.where(F.col("day") >= F.lit(DAYS[3])), "id", "day", "loaded", compare, root)
        assert sorted(map(str, grown.collect())) == want


def test_many_keys_stay_in_order(spark):
    r = random.Random(4)
    rows = [(f"k{r.randrange(10**9)}", d, None, "1", None, None, None) for d in DAYS[:3] for _ in range(4000)]
    keep = [f"s{i}é" for i in range(4000)]
    rows += [(k, d, None, str(i % 2 if k > "s2" else 1), None, None, None) for k in keep for i, d in enumerate(DAYS[:3])]
    r.shuffle(rows)
    got = snapshot_changes(spark.createDataFrame(rows, SNAP).repartition(9), "id", "day", "loaded", {"n": F.col("num")}, ranges=3)
    counts = {(x.day, x.change): x["count"] for x in got.groupBy("day", "change").count().collect()}
    changed = sum(k > "s2" for k in keep)
    want = {}
    for a, b in zip(DAYS[:3], DAYS[1:3]):
        before, after = ({x[0] for x in rows if x[1] == d} for d in (a, b))
        want |= {(b, "added"): len(after - before), (b, "removed"): len(before - after), (b, "changed"): changed}
    assert counts == want


@pytest.mark.parametrize("seed", [1, 2])
def test_history_against_brute_force(spark, seed):
    rows = snapshots(seed)
    df = spark.createDataFrame(rows, SNAP)
    got = {tuple(x) for x in attribute_history(df, "id", "day", "loaded", {"n": numeric_text(F.col("num")).cast("bigint"), "d": F.col("d")}).collect()}
    h = held(rows)
    want = set()
    for k in {k for k, _ in h}:
        start = None
        for i, day in enumerate(DAYS):
            v, after = h.get((k, day)), h.get((k, DAYS[i + 1])) if i + 1 < len(DAYS) else None
            gone = (k, day) not in h
            if gone:
                continue
            start = start or day
            last = i + 1 == len(DAYS)
            if last or (k, DAYS[i + 1]) not in h or after != v:
                want.add((k, *v, str(start), "9999-12-31" if last else str(DAYS[i + 1])))
                start = None
    assert got == want


def test_snapshots_of_nothing(spark):
    df = spark.createDataFrame([], SNAP)
    assert snapshot_changes(df, "id", "day", "loaded", {"n": F.col("num")}).collect() == []
    assert attribute_history(df, "id", "day", "loaded", {"n": F.col("num")}).collect() == []
    one = spark.createDataFrame([("a", DAYS[0], None, "1", None, None, None)], SNAP)
    assert snapshot_changes(one, "id", "day", "loaded", {"n": F.col("num")}).collect() == []
    assert [tuple(x) for x in attribute_history(one, "id", "day", "loaded", {"n": F.col("num")}).collect()] == [("a", "1", "2026-01-05", "9999-12-31")]


def test_relational(spark):
    a = spark.createDataFrame([("x", 1, "p"), ("x", 2, "q"), (None, 1, "r"), ("y", 5, None)], "id string, n int, v string")
    assert sorted((r.id or "", r.v) for r in relational.first_per_key(a, "id", [F.col("n").desc()]).collect()) == [("", "r"), ("x", "q"), ("y", None)]
    assert [tuple(r) for r in relational.duplicate_keys(a, ["id"]).collect()] == [("x", 2)]
    with pytest.raises(relational.GateError):
        relational.require_empty(relational.duplicate_keys(a, ["id"]), "duplicates")
    relational.require_empty(a.limit(0), "fine")
    got = {r.id: (r.n_versions, r.n, r.v) for r in relational.latest_with(a, "id", ["n"], ["v"], F.col("v").isNotNull()).collect()}
    assert got == {"x": (2, 2, "q"), None: (1, 1, "r"), "y": (1, None, None)}
    p = spark.createDataFrame([("x", None, True)], "id string, v string, fresh boolean")
    got = relational.merge_patches(a, p, "id", ["v", "fresh"]).collect()
    assert sorted((r.id or "", r.v or "", r.fresh) for r in got) == [("", "r", None), ("x", "", True), ("x", "", True), ("y", "", None)]
    assert {r.id for r in relational.without(a, "id", p, "id").collect()} == {None, "y"}
    assert {(r.id, r.state) for r in relational.inventory_diff(a, p.union(spark.createDataFrame([("z", None, None)], p.schema)), "id").collect()} == {("x", "both"), ("y", "missing"), ("z", "extra")}
    assert {r.fresh for r in relational.lookup(a.select("id"), "id", p, "id", ["fresh"], {"fresh": False}).collect()} == {True, False}
    lines = spark.createDataFrame([("NATION_10 x",), ("a.c",), ("abc",), (None,)], "line string")
    needles = spark.createDataFrame([("NATION_1",), ("a.c",), ("",), (None,), ("NATION_1",), ("longer than the anchor is",)], "n string")
    long = lines.union(spark.createDataFrame([("it is longer than the anchor is.",), ("longer than the anchor was",), ("",)], "line string"))
    for sent in (100, 1):
        assert {r.line for r in relational.lines_without(long, "line", needles, sent).collect()} == {"abc", None, "", "longer than the anchor was"}
        assert {r.line for r in relational.lines_with(long, "line", needles, sent).collect()} == {"NATION_10 x", "a.c", "it is longer than the anchor is."}
        assert relational.lines_with(long.limit(0), "line", needles, sent).count() == 0
    assert relational.lines_without(long, "line", needles.limit(0)).count() == long.count()
    with pytest.raises(relational.GateError) as e:
        relational.require_empty(spark.createDataFrame([("C1", "secret@mail.example")], "id string, v string"), "left", ["id"])
    assert "C1" in str(e.value) and "secret" not in str(e.value)
    scans = [F.col("n") == 2, F.col("n") > 0, F.lit(None).cast("boolean")]
    assert {(r.id, r.n, r.scan) for r in relational.first_scan(a, scans).collect()} == {("x", 1, 1), ("x", 2, 0), (None, 1, 1), ("y", 5, 1)}
    assert sorted(tuple(r) for r in relational.scan_counts(a, scans).collect()) == [(0, 1, 1), (1, 4, 3), (2, 0, 0)]


def test_lookup_states(spark):
    cases = {
        (False, None, None, None, None, None, None): "error", (True, False, True, None, None, None, None): "error", (True, None, False, False, None, None, None): "error",
        (True, None, False, True, False, None, None): "error", (True, None, False, True, True, None, None): "gone", (True, True, True, None, None, True, None): "unchanged",
        (True, True, True, None, None, False, None): "no-document", (True, True, True, None, None, False, True): "superseded",
    }
    df = spark.createDataFrame(list(cases), "a boolean, b boolean, c boolean, d boolean, e boolean, f boolean, g boolean")
    got = df.select("*", relational.lookup_state(*[F.col(c) for c in "abcdefg"]).alias("s")).collect()
    assert {tuple(r)[:7]: r.s for r in got} == cases


def test_sequences(spark):
    df = spark.createDataFrame([("d", 1, "a"), ("d", 2, None), ("d", 3, "b"), ("d", 4, "b"), ("e", 1, None)], "id string, pos int, v string")
    got = sequence.running_count(df, "id", ["pos"], F.col("v") == "b", "n")
    got = sequence.carry_forward(got, "id", ["pos"], F.col("v"), "c")
    got = sequence.look_ahead(got, "id", ["pos"], F.col("v"), "l")
    got = sequence.islands(got, "id", ["pos"], F.col("v"))
    got = sequence.row_ids(got, "id", ["pos"], "v", "rid")
    assert sorted((r.id, r.pos, r.n, r.c, r.l, r.island, r.rid) for r in got.collect()) == [
        ("d", 1, 0, "a", None, 1, "d:0001:a"), ("d", 2, 0, "a", "b", 2, "d:0002:-"), ("d", 3, 1, "b", "b", 3, "d:0003:b"), ("d", 4, 2, "b", None, 3, "d:0004:b"), ("e", 1, 0, None, None, 1, "e:0001:-")]
    top = sequence.top_per_group(df, "id", [F.col("pos").desc()], 2).collect()
    assert sorted((r.id, r.pos, r["rank"], r.remainder) for r in top) == [("d", 3, 2, 2), ("d", 4, 1, 2), ("e", 1, 1, 0)]
    n = sequence.nth_of_total(df, "id", ["pos"]).collect()
    assert {(r.id, r.n, r.total) for r in n} >= {("d", 4, 4), ("e", 1, 1)}


def test_global_numbers_follow_the_order_whatever_the_partitions(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id"))
    for n in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = [(r.k, r.n) for r in sequence.number_globally(df, ["k"], "n").collect()]
        assert [k for k, _ in sorted(got, key=lambda x: x[1])] == sorted(k for k, _ in got) and {i for _, i in got} == set(range(1, 1001))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sequence.number_globally(df.limit(0), ["k"], "n").count() == 0


def section_frame(spark, texts):
    base = ["register_id", "act", "collection", "compilation_number", "compilation_date", "section", "heading", "register_page"]
    rows = [(*["C2004A05138", "Excise Act", None, None, None, str(i), "h‑x", None], f"r{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*base, "row_id", "text"]))


def test_number_records(spark):
    s = section_frame(spark, [
        "| a | b |\n|---|---|\n| x | 5% |\nThe rate is 10% of the value now. The sum of $5 is paid each year.",
        "The limit is $1,200 from 1 July 2001. Amounts are indexed by 2% a year.", "The factor is 2.0802 for the year 2001‑02.", "A 10% stake in the firm is held.", "no number at all", None, "",
    ])
    got = [(r.row_id, r.kind, r.amounts, r.years) for r in numbers.number_records(s).orderBy("row_id", "part", "pos").collect()]
    assert got == [
        ("r0", "table", None, []), ("r0", "rate", ["10%"], []), ("r1", "threshold", ["$1,200"], ["2001"]), ("r1", "indexation", ["2%"], []),
        ("r2", "factor", ["2.0802"], ["2001‑02"]), ("r3", "ownership test", ["10%"], [])]
    ids = {r.rate_id for r in numbers.number_index(s).collect()}
    assert ids == {f"R{i:05d}" for i in range(1, 7)}
    assert {(r.dimension, r.value, r.n) for r in rollup.histograms(numbers.number_records(s), ["kind", "collection"]).collect()} >= {("collection", "unknown", 6), ("kind", "rate", 1)}


def test_privacy_and_rollup(spark):
    t = "Wilma Obermoor 12345678; Tom McRay 22345678; Ann Bell-Lee 32345678 a@b.example"
    s = section_frame(spark, [t, "Wilma Obermoor 12345678", None, ""])
    hot = privacy.person_rows(s)
    assert [(r.row_id, r.names, r.numbers) for r in hot.collect()] == [("r0", 3, 3)]
    assert privacy.person_rows(s, 1, 1).count() == 2
    (r,) = privacy.title_rollup(hot, s).collect()
    assert (r.rows_total, r.rows_flagged, r.names_est, r.words) == (4, 1, 3, 10)
    c = privacy.contact_fingerprints(s, ["register_id"], "text")
    allow = c.select("kind", "sha256", "register_id")
    assert c.count() == 1 and privacy.unapproved(c, allow).count() == 0 and privacy.unapproved(c, allow.limit(0)).count() == 1
    tfn = c.select("register_id", F.lit("tfn").alias("kind"), "sha256")
    assert privacy.unapproved(tfn, tfn.select("kind", "sha256", "register_id")).count() == 1
    got = {r.collection: (r.titles, r.rows, r.section_rows) for r in rollup.corpus_rollup(s).collect()}
    assert got == {"unknown": (1, 4, 4), "*": (1, 4, 4)}
    assert {r.collection: r.words for r in rollup.corpus_rollup(s.limit(0)).collect()} == {"*": 0}


def test_once_per_key_by_bitmap_is_the_aggregation(spark):
    from tabularium.sources.bitmaps import bitmap
    from tabularium.sources.tables import once_per_key

    rows = [(f"k{i % 37}" if i % 37 else None, i % 5 or None, f"t{i}", None) for i in range(60)] + [("once", 1, None, "x")]
    df = spark.createDataFrame(rows, "k string, at int, text string, h string")
    for d in (df, df.limit(0), df.where("k = 'once'")):
        got = [sorted(map(tuple, once_per_key(d, "k", ["text", "h"], "at", wide=w).collect()), key=str) for w in (False, True)]
        assert got[0] == got[1]
    b = bitmap(spark.range(-50, 50).selectExpr("xxhash64(id) AS h"))
    inside = [r.h for r in spark.range(-50, 50).selectExpr("xxhash64(id) AS h").collect()]
    outside = [r.h for r in spark.range(1000, 3000).selectExpr("xxhash64(id) AS h").collect()]
    import numpy as np

    assert b.has(np.array(inside)).all() and b.has(np.array(outside)).mean() < 0.01
    assert bitmap(spark.createDataFrame([(None,)], "h bigint")).empty


def test_ordinals_of_a_hot_group_and_of_nulls(spark):
    rows = [("hot", i * 7 % 500) for i in range(500)] + [(f"g{i % 9}", i) for i in range(40)] + [(None, 3), (None, 1)]
    df = spark.createDataFrame(rows, "id string, pos int").repartition(5)
    got = {(r.id, r.pos): r.n for r in sequence.ordinals_in_ranges(df, "id", ["pos"], "n").collect()}
    assert got == {(r.id, r.pos): r.n for r in sequence.ordinals(df, "id", ["pos"], "n").collect()} and len(got) == len(rows)
    assert sequence.ordinals_in_ranges(df.limit(0), "id", ["pos"]).count() == 0
