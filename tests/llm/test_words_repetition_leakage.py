"""Word hashes, repetition and leakage against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.llm.leakage import leaks, tiles
from tabularium.llm.repetition import Ratios, repetition
from tabularium.llm.words import chunks, words

WORD = re.compile("[A-Za-z0-9]+")


def plain(text):
    return [w.lower() for w in WORD.findall(text or "")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é\n,", max_size=30)), max_size=8))
def test_words_equal_where_the_words_are_equal(texts):
    w = words(pa.array(texts, pa.string()))
    flat = [x for t in texts for x in plain(t)]
    assert len(w.hash) == len(flat)
    assert np.diff(w.first).tolist() == [len(plain(t)) for t in texts]
    by = {}
    for x, h in zip(flat, w.hash.tolist()):
        assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=40), max_size=5), st.integers(1, 4))
def test_grams_stay_within_a_text(texts, n):
    w = words(pa.array(texts, pa.string()))
    g, at = w.grams(n)
    want = [tuple(p[i : i + n]) for p in map(plain, texts) for i in range(len(p) - n + 1)]
    assert len(g) == len(want)
    assert len(set(g.tolist())) == len(set(want))


def test_sliced_arrays_and_chunks():
    batch = pa.record_batch({"k": pa.array(range(5)), "text": pa.array(["a b", None, "c" * 50, "", "d e f"])})
    assert np.diff(words(batch.column(1).slice(2, 3)).first).tolist() == [1, 0, 3]
    assert [c.num_rows for c in chunks(batch, "text", 10)] == [2, 1, 2]
    assert sum(c.num_rows for c in chunks(batch.slice(0, 0), "text")) == 0


def share(text, n=8):
    w, seen, covered = plain(text), set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i : i + n])
        if g in seen:
            covered |= set(range(i, i + n))
        seen.add(g)
    return len(covered), len(w)


def test_repetition_against_brute_force(spark):
    r = random.Random(5)
    texts = [None, "", "one", "a " * 500, "x. " * 8, "é" * 20]
    for _ in range(60):
        base = [r.choice("abcdefghij") + str(r.randrange(30)) for _ in range(r.randrange(1, 80))]
        if r.random() < 0.5:
            k = r.randrange(len(base))
            base += base[k : k + r.randrange(4, 30)]
        texts.append((" " if r.random() < 0.5 else "-").join(base))
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "b " * 20, "x"), (7, texts[7], "x")]
    df = spark.createDataFrame(rows, "id int, t string, key string")
    for buckets, trusted in ((1 << 20, F.col("id") % 3 == 0), (64, F.col("id") == 12), (64, F.lit(None).cast("boolean"))):  # the result stays, and nothing is lost
        out = repetition(df, "id", "t", trusted, buckets=buckets).collect()
        got = sorted(((x["id"] is None, x["id"], x["n_words"], x["repeated_words"]) for x in out), key=str)
        want = sorted(((i is None, i, *reversed(share(t))) for i, t, _ in rows), key=str)
        assert got == want
        assert all(x["repetitive"] for x in out if x["n_words"] and x["repeated_share"] >= 0.3)


def test_the_threshold_parts_clean_documents_and_takes_empty_tables(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(50))) for i in range(30)] + [(30, "a b c d e f g h " * 3), (31, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {x["id"]: x for x in repetition(df, "id", "t", F.col("id") < 10).collect()}
    assert {i for i, x in got.items() if x["repetitive"]} == {30} and got[30]["repeated_share"] == pytest.approx(2 / 3)
    assert got[30]["score"] < 0 < got[1]["score"] and got[31]["score"] == 0
    assert repetition(df.limit(0), "id", "t", F.lit(True)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=64, max_size=64), st.integers(0, 5000), st.integers(0, 5000), st.floats(0.05, 1.0))
def test_no_share_scores_above_the_threshold(again, fresh, trusted, least):
    again = np.array(again)
    r = Ratios(again, int(again.sum()) + fresh, trusted, least, 8)
    seen = np.flatnonzero(again)
    if len(seen):
        most = r.again[seen].max()
        for share in (least / 8, least, 1.0):
            assert share * most + (1 - share) * r.new <= r.threshold


def test_tiles_take_the_longest_first_and_count_each_word_once():
    # item words 0..9 stand twice in the document, the first time only in part
    i = np.array([0, 1, 10, 11, 12, 13, 14])
    j = np.array([3, 4, 0, 1, 2, 3, 4])
    got = tiles(i, j, 3)
    assert got == [(10, 0, 7)]


def brute_leaks(docs, items, verbatim):
    out = set()
    for d, dt in docs:
        dw = plain(dt)
        for i, it in items:
            iw = plain(it)
            k = min(verbatim, len(iw))
            if k and any(dw[a : a + k] == iw[b : b + k] for a in range(len(dw) - k + 1) for b in range(len(iw) - k + 1)):
                out.add((i, d))
    return out


def test_leaks_against_brute_force(spark):
    r = random.Random(3)
    say = lambda n: [f"w{r.randrange(40)}" for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([1, 2, 5, 9, 14, 15, 20, 40])] + [(90, ""), (91, None), (3, None)]
    docs = []
    for d in range(80):
        w = say(60)
        n = r.choice([0, 10, 14, 15, 18])
        src = plain(r.choice([t for _, t in items if t]))
        k = r.randrange(max(1, len(src) - n + 1))
        at = r.randrange(60)
        docs.append((d, ("  " if d % 2 else ", ").join(w[:at] + src[k : k + n] + w[at:]).upper()))
    docs += [(80, None), (81, ""), (None, " ".join(plain(items[5][1])))]
    D = spark.createDataFrame([(*x, "z") for x in docs], "doc_id int, text string, item_id string")
    I = spark.createDataFrame([(*x, "q") for x in items], "item_id int, text string, seed string")  # noqa: E741
    both = [leaks(D.withColumnRenamed("item_id", "i"), "doc_id", "text", I, "item_id", "text", sent_seeds=k).collect() for k in (10**6, 0)]
    assert sorted(both[0], key=str) == sorted(both[1], key=str) and len(set(both[0])) == len(both[0])
    assert {(x["item_id"], x["doc_id"]) for x in both[0] if x["verbatim"]} == brute_leaks(docs, items, 15)


def plain_tiles(d, i, seed):
    """Greedy tiling by its definition: the longest unmarked match again and again, ties by place."""
    free_d, free_i, found = [True] * len(d), [True] * len(i), []
    while True:
        best = (seed - 1, 0, 0)
        for a in range(len(d)):
            for b in range(len(i)):
                k = 0
                while a + k < len(d) and b + k < len(i) and d[a + k] == i[b + k] and free_d[a + k] and free_i[b + k]:
                    k += 1
                if k > best[0]:
                    best = (k, a, b)
        if best[0] < seed:
            return found
        k, a, b = best
        found.append(k)
        for x in range(k):
            free_d[a + x] = free_i[b + x] = False


def test_reordered_passages_of_five_words_and_more_are_all_found(spark):
    r = random.Random(9)
    items = [(i, [f"i{i}x{k}" for k in range(r.randrange(12, 60))]) for i in range(12)]
    docs = []
    for d in range(90):
        _, w = r.choice(items)
        parts, at = [], 0
        while at < len(w):
            n = r.randrange(3, 9)
            parts.append(w[at : at + n])
            at += n
        r.shuffle(parts)
        parts = parts[: r.randrange(1, len(parts) + 1)]
        docs.append((d, [x for p in parts for x in [*p, f"z{r.randrange(10**6)}"]]))
    D = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id int, text string")
    I = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id int, text string")  # noqa: E741
    want = {}
    for d, dw in docs:
        for i, iw in items:
            t = plain_tiles(dw, iw, 5)
            if t and (max(t) >= min(15, len(iw)) or sum(t) >= 0.5 * len(iw)):
                want[i, d] = sum(t)
    for k in (10**6, 0):
        got = {(x["item_id"], x["doc_id"]): x["covered"] for x in leaks(D, "doc_id", "text", I, "item_id", "text", sent_seeds=k).collect()}
        assert got == want and len(want) > 10


def test_common_seeds_in_slices(spark, monkeypatch):
    import tabularium.llm.leakage as lk

    text = "one two three four five six " * 30
    D = spark.createDataFrame([(1, text), (2, "one two three four five six"), (3, "none")], "doc_id int, text string")
    I = spark.createDataFrame([(i, f"one two three four five six q{i}") for i in range(20)], "item_id int, text string")  # noqa: E741
    want = sorted(leaks(D, "doc_id", "text", I, "item_id", "text").collect())
    assert len(want) == 40
    s = lk.Seeds(pa.table({"item": pa.array(range(20)), "seed": pa.array([5] * 20), "j": pa.array([0] * 20, pa.int32()), "n": pa.array([6] * 20, pa.int32()), "k": pa.array([5] * 20, pa.int32())}))
    monkeypatch.setattr(lk, "HITS", 50)
    slices = list(lk._expanded(s, np.array([0] * 10 + [1]), np.arange(11), np.zeros(11, np.int64)))
    assert sum(len(x[0]) for x in slices) == 220 and max(len(x[0]) for x in slices) <= 50
    assert len({(d, i) for x in slices for d, i in set(zip(x[0].tolist(), x[1].tolist()))}) == sum(len(set(zip(x[0].tolist(), x[1].tolist()))) for x in slices)


def test_reordered_passages_are_covered(spark):
    w = [f"w{i}" for i in range(30)]
    D = spark.createDataFrame([(1, " ".join(w[20:30] + ["x"] + w[10:20] + ["y"] + w[0:10])), (2, " ".join(w[:9]))], "doc_id int, text string")
    I = spark.createDataFrame([(1, " ".join(w))], "item_id int, text string")  # noqa: E741
    got = leaks(D, "doc_id", "text", I, "item_id", "text").collect()
    assert [(x["doc_id"], x["covered"], x["longest"], x["verbatim"]) for x in got] == [(1, 30, 10, False)]
    assert leaks(D.limit(0), "doc_id", "text", I, "item_id", "text").collect() == []
    assert leaks(D, "doc_id", "text", I.limit(0), "item_id", "text").collect() == []
