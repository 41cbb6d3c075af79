"""Near-duplicates and mixing."""

import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tabularium.llm import neardup as nd
from pyspark.sql import functions as F

from tabularium.llm.mixing import mix, plan, report, reversed_bits, schedule, token_counts

WORD = re.compile("[A-Za-z0-9]+")


def sets(rows, k, least):
    out = {}
    for key, t in rows:
        w = [x.lower() for x in WORD.findall(t or "")]
        if key is not None and len(w) >= max(least, k):
            out.setdefault(key, set()).update({tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    return out


def brute(rows, k, num, den, least):
    s = sets(rows, k, least)
    return {tuple(sorted((a, b))) for a, b in combinations(s, 2) if len(s[a] & s[b]) * den >= len(s[a] | s[b]) * num}


def corpus(seed, n, vocabulary, lengths):
    r = random.Random(seed)
    word = lambda: f"w{int(vocabulary * r.random() ** 3)}"
    texts = []
    for _ in range(n):
        if texts and r.random() < 0.6:
            w = r.choice(texts).split()
            for _ in range(r.randrange(0, 1 + len(w) // 12)):
                i = r.randrange(len(w))
                w[i : i + r.randrange(2)] = [word() for _ in range(r.randrange(2))]
            if r.random() < 0.3:
                w += [word() for _ in range(r.randrange(len(w) // 2 + 1))]
            texts.append(" ".join(w) or "w")
        else:
            texts.append(" ".join(word() for _ in range(r.choice(lengths))))
    return [(f"k{i:04d}", t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,vocabulary,lengths,k,num,den,least", [
    (1, 60, [3, 10, 45, 60, 150], 3, 3, 5, 40), (2, 5000, [20, 80, 300], 3, 3, 5, 0), (3, 400, [30, 100], 5, 4, 5, 0), (4, 15, [12, 25, 50], 3, 3, 5, 0)])
def test_every_similar_pair_is_found(spark, seed, vocabulary, lengths, k, num, den, least):
    rows = corpus(seed, 220, vocabulary, lengths)
    rows += [("copy1", rows[0][1].upper()), ("copy2", rows[0][1]), rows[3], ("null", None), (None, rows[1][1]), ("empty", "")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "row_id string, text string, set_id int")
    members, links = nd.similar(df, "row_id", "text", shingle=k, threshold=(num, den), least_words=least)
    got = {(x["row_id_a"], x["row_id_b"]) for x in nd.expand(members, links, "row_id").collect()}
    assert got == brute(rows, k, num, den, least)


@pytest.mark.parametrize("neighbourhoods", [True, False])
@pytest.mark.parametrize("k,num,den", [(3, 3, 5), (2, 9, 10), (1, 1, 3)])
def test_either_index_finds_every_pair(spark, neighbourhoods, k, num, den):
    rows = corpus(11, 160, 900, [1, 2, 6, 17, 40, 90, 200])
    df = spark.createDataFrame(rows, "row_id string, text string")
    members, links = nd.similar(df, "row_id", "text", shingle=k, threshold=(num, den), neighbourhoods=neighbourhoods)
    got = {(x["row_id_a"], x["row_id_b"]) for x in nd.expand(members, links, "row_id").collect()}
    assert got == brute(rows, k, num, den, 0)


def test_neighbourhoods_are_allocated_where_shingles_are_common():
    sizes = np.zeros(nd.BANDS, np.int64)
    sizes[2] = 10_000
    rare, common = np.full(nd.SKETCH, 2), np.zeros(nd.SKETCH, np.int64)
    common[:300] = 4_000
    assert not nd.allocation(rare, sizes, 4, 5)[2] and nd.allocation(common, sizes, 9, 10)[2]
    assert not nd.allocation(common * 0, sizes, 4, 5).any()


def test_words_survive_packing():
    r = np.random.default_rng(1)
    h, doc = r.integers(0, 1 << 63, 5000).astype(np.uint64), r.integers(0, 50, 5000)
    tag, whole = r.integers(0, 1 << 35, 50).astype(np.uint64), r.random(5000) < 0.5
    got = {p: nd.unpacked(a, b) for p, a, b in nd.packed(doc, h, whole, tag, 7)}
    want = {(int(x % (1 << 36)) % 7, int(x >> 36), int(tag[d]), bool(f)) for x, d, f in zip(h.tolist(), doc, whole)}
    assert {(p, int(x >> 36), int(x >> 1) % (1 << 35), bool(x & 1)) for p, v in got.items() for x in v.tolist()} == want


def test_many_texts_take_little_memory():
    r = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(r.choices(words, k=300)) for _ in range(4000)]
    edited = [t if i % 4 else t[len(t) // 2 :] for i, t in enumerate(texts)]

    def peak(f):
        tracemalloc.start()
        try:
            return f(), tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    (token, doc), mb = peak(lambda: nd._sets(pa.array(texts), 3, 40))
    assert mb < 100  # 7 MB of texts, 19 MB of shingles
    want = [nd._sets(pa.array([t]), 3, 40)[0] for t in texts]
    assert (token == np.concatenate(want)).all() and (doc == np.repeat(np.arange(4000), list(map(len, want)))).all()
    ids = pa.array(range(4000))
    batch = pa.record_batch([ids, ids, pa.array(texts), pa.array(edited)], ["a", "b", "ta", "tb"])
    got, mb = peak(lambda: pa.Table.from_batches(nd.verified(batch, 3, 40, 3, 5)))
    assert mb < 100
    assert got.column("a").to_pylist() == [i for i in range(4000) if i % 4]
    assert got.column("common").to_pylist() == got.column("total").to_pylist() == [len(want[i]) for i in range(4000) if i % 4]


def test_blocks_of_copies(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    members = spark.createDataFrame([(f"k{i:02d}", i % 2 * 7) for i in range(60)], "row_id string, set_id bigint")
    got = nd.expand(members, spark.createDataFrame([], "a bigint, b bigint"), "row_id").collect()
    assert len(got) == len(set(got)) == 2 * 30 * 29 // 2 and all(x["row_id_a"] < x["row_id_b"] for x in got)


def test_thresholds_out_of_range(spark):
    with pytest.raises(ValueError):
        nd.similar(spark.createDataFrame([], "k string, t string"), "k", "t", threshold=(1, 5))


def test_classes_are_the_connected_components(spark):
    rows = corpus(7, 150, 3000, [60, 90])
    df = spark.createDataFrame(rows, "row_id string, text string")
    members, links = nd.similar(df, "row_id", "text", shingle=3, threshold=(3, 5))
    got = {x["row_id"]: x["class_id"] for x in nd.classes(members, links, "row_id").collect()}
    parent = {k: k for k in sets(rows, 3, 0)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(rows, 3, 3, 5, 0):
        parent[find(a)] = find(b)
    assert set(got) == set(parent)
    ours = {}
    for k, c in got.items():
        ours.setdefault(c, set()).add(k)
    theirs = {}
    for k in parent:
        theirs.setdefault(find(k), set()).add(k)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_a_hot_group_of_copies_and_an_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(f"k{i}", text) for i in range(50)] + [("other", " ".join(f"v{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "row_id string, text string")
    members, links = nd.similar(df, "row_id", "text")
    assert links.count() == 0 and members.select("set_id").distinct().count() == 2
    assert nd.expand(members, links, "row_id").count() == 50 * 49 // 2
    members, links = nd.similar(df.limit(0), "row_id", "text")
    assert members.count() == 0 and links.count() == 0 and nd.classes(members, links, "row_id").count() == 0


def docs(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", None]), "word " * r.randrange(1, 60)) for i in range(400)]
    return spark.createDataFrame([*rows, (400, "a", None), (401, "b", ""), (None, "c", "x y")], "doc_id int, source string, text string")


def test_mix_reaches_the_targets(spark):
    counts = token_counts(docs(spark), "doc_id", "source", "text")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 4), ("c", 0.29, 1), ("none", 0.01, 3)], "source string, target_share double, max_repeats int")
    mixed, plans = mix(counts, targets, block=64)
    rows = mixed.collect()
    p = {x["source"]: x for x in plans.collect()}
    total = p["a"]["total"]
    assert total == counts.groupBy().sum("n_tokens").collect()[0][0]
    uses = {}
    for x in rows:
        uses[x["source"], x["doc"], x["epoch"]] = uses.get((x["source"], x["doc"], x["epoch"]), 0) + 1
        assert x["epoch"] < p[x["source"]]["max_repeats"]
    assert set(uses.values()) == {1}
    for s in "abc":
        got = sum(x["n_tokens"] for x in rows if x["source"] == s)
        assert p[s]["quota"] <= got <= p[s]["quota"] + 70 or not p[s]["reaches"] and got == p[s]["tokens"] * p[s]["max_repeats"]
    assert not p["none"]["reaches"] and p["a"]["reaches"] == (p["a"]["tokens"] >= 0.4 * total)
    # any stretch of the schedule is close to the shares
    order = [x["source"] for x in sorted({(x["slot"], x["source"]) for x in rows} and rows, key=lambda x: (x["slot"], x["start"]))]
    half = order[: len(order) // 2]
    for s in "abc":
        assert abs(half.count(s) / len(half) - order.count(s) / len(order)) < 0.12
    assert {x["source"]: x["mixed_tokens"] for x in report(mixed, plans).collect()}["none"] == 0


def test_schedule_gives_every_block_one_slot_and_keeps_the_shares(spark):
    want = [(f"s{i}", n) for i, n in enumerate([700, 1, 120, 3, 3, 50, 400, 1, 9])] + [("z", 2000)]
    total = sum(n for _, n in want)
    rows = schedule(spark, spark.createDataFrame(want, "source string, blocks bigint"), total).orderBy("slot").collect()
    assert len({x["slot"] for x in rows}) == len(rows) == total
    seen = {}
    for k, x in enumerate(rows, 1):
        seen[x["source"]] = seen.get(x["source"], 0) + 1
        assert x["block"] == seen[x["source"]] - 1
        if k % 500 == 0:
            assert all(abs(seen.get(s, 0) - n * k / total) < 8 for s, n in want)
    assert seen == dict(want)


def test_reversed_bits(spark):
    for bits in (1, 7, 33, 62):
        values = [random.Random(bits).randrange(1 << bits) for _ in range(50)]
        got = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", reversed_bits(F.col("v"), bits).alias("r")).collect()
        assert all(x["r"] == int(f"{x['v']:0{bits}b}"[::-1], 2) for x in got)


def test_more_sources_than_are_sent(spark, monkeypatch):
    import tabularium.llm.mixing as mx

    counts = token_counts(docs(spark), "doc_id", "source", "text")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 9)], "source string, target_share double, max_repeats int")
    one = sorted(mix(counts, targets, block=64)[0].collect(), key=str)
    monkeypatch.setattr(mx, "SENT_SOURCES", 0)
    assert sorted(mix(counts, targets, block=64)[0].collect(), key=str) == one


def test_mix_of_nothing(spark):
    counts = token_counts(docs(spark).limit(0), "doc_id", "source", "text")
    targets = spark.createDataFrame([("a", 1.0, 1), (None, 0.5, 1), ("b", None, None)], "source string, target_share double, max_repeats int")
    assert {(x["source"], x["reaches"]) for x in plan(counts, targets).collect()} == {("a", True), ("b", True)}
    mixed, plans = mix(counts, targets)
    assert mixed.count() == 0 and report(mixed, plans).count() == 2
