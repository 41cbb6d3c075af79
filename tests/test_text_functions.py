"""Column functions against plain statements of their rules."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tabularium.functions import identifiers as I  # noqa: E741
from tabularium.functions import text as X


def run(spark, texts, **columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.asDict() for r in df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()]


def noise(seed, alphabet, n=400, most=30):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(most))) for _ in range(n)]


def money(s):
    out, i = [], 0
    while i < len(s):
        if s[i] != "$":
            i += 1
            continue
        j = i + 1
        if j < len(s) and s[j].isspace():
            j += 1
        k = j
        while k < len(s) and (s[k].isdecimal() or (s[k] == "," and k > j and s[k + 1 : k + 2].isdecimal())):
            k += 1
        if k == j:
            i = j
            continue
        if s[k : k + 1] == "." and s[k + 1 : k + 2].isdecimal():
            k += 1
            while k < len(s) and s[k].isdecimal():
                k += 1
        out.append(s[i:k])
        i = k
    return out


def percent(s):
    return [m for m in re.findall(r"\d+(?:\.\d+)?\s?%?", s) if m.endswith("%")]


def test_amounts_fuzz(spark):
    texts = [*noise(1, "$1,. %9 a"), "1.2.3%", "$ 1,234.50.", "$", "", "12 % 5%"]
    got = run(spark, texts, m=X.money_values(F.col("t")), p=X.percentage_values(F.col("t")), f=X.factor_values(F.col("t")))
    for t, g in zip(texts, got):
        assert g["m"] == money(t), t
        assert g["p"] == percent(t), t
        assert g["f"] == re.findall(X.FACTOR, t), t


def sentence_rule(t):
    plain = "\n".join(x for x in t.split("\n") if not x.startswith("|"))
    out = re.split(r"(?<=[.;:])\s+(?=[A-Z(•*])|\n{2,}", plain)
    return [s.strip() for s in out if 15 < len(s.strip()) < 600]


def test_sentences_fuzz(spark):
    texts = [*noise(2, "aB.;:(\n |•", most=120), "| a |\nOne sentence that is long. Another sentence that is long.\n\nlower case paragraph here", ""]
    for t, g in zip(texts, run(spark, texts, s=X.sentences(F.col("t")), b=X.table_blocks(F.col("t")))):
        assert g["s"] == sentence_rule(t), t
        blocks, cur = [], []
        for line in [*t.split("\n"), ""]:
            if line.startswith("|"):
                cur.append(line)
            elif cur:
                blocks.append("\n".join(cur))
                cur = []
        assert g["b"] == blocks, t


def test_linear_time(spark):
    long = ["9" * 200_000, "$ " * 100_000, "tax file number" + " " * 100_000, "A. " * 60_000, "|" * 200_000, "1." * 100_000]
    start = time.time()
    run(spark, long, m=F.size(X.money_values(F.col("t"))), p=F.size(X.percentage_values(F.col("t"))), s=F.size(X.sentences(F.col("t"))), b=F.size(X.table_blocks(F.col("t"))), c=F.size(I.contact_values(F.col("t"))))
    assert time.time() - start < 60


def test_nulls_stay_null(spark):
    t = F.col("t")
    (g,) = run(spark, [None], w=X.word_count(t), m=X.money_values(t), s=X.sentences(t), f=X.fold(t), k=F.size(X.keywords_in(t, ["Tax"])), d=X.diagnostic(t), r=X.is_register_id(t), topic=X.topic_for(t, t, t))
    assert g["m"] is None and g["s"] is None and g["f"] is None and g["k"] == 0 and g["d"] == "?" and g["r"] is False and g["topic"] == "other"


def test_words_keywords_labels_and_folds(spark):
    t = F.col("t")
    texts = ["", "  a b\nc ", "Rotax Tax TAX"]
    assert [g["w"] for g in run(spark, texts, w=X.word_count(t))] == [0, 3, 3]
    names = ["AD/ROTAX/1", "the Tax (Rates) Act", "Excise tax", "Customs Tariff"]
    assert [g["k"] for g in run(spark, names, k=X.keywords_in(t, ["Tax", "Excise", "Customs Tariff"]))] == [[], ["Tax"], ["Tax", "Excise"], ["Customs Tariff"]]
    heads = ["12 ‑ 5AB X", "8AAZLGA. Y", "Notes.", "7", "1 October"]
    assert [g["l"] for g in run(spark, heads, l=X.section_label(t))] == ["12-5AB", "8AAZLGA", None, "7", "1"]
    assert run(spark, ["a‑b–c d"], f=X.fold(t))[0]["f"] == "a-b-c d"
    assert run(spark, ["a|b\nc"], c=X.cell(t, 5))[0]["c"] == "a\\|b "
    assert [g["h"] for g in run(spark, ["25", "75", "5404"], h=X.half_even_to(t.cast("int"), 50))] == [0, 100, 5400]
    assert [g["d"] for g in run(spark, ["x\x00\n y", "\x01"], d=X.diagnostic(t, 3))] == ["x y", "?"]


def test_dates_and_ids(spark):
    t = F.col("t")
    got = run(spark, ["2026-02-03", "2026-2-3", "2026-02-30", "20260203"], d=X.iso_date(t).cast("string"))
    assert [g["d"] for g in got] == ["2026-02-03", None, None, None]
    got = run(spark, ["2026-02-03T01:02:03Z", "2026-02-03T01:02:03.123456Z", "2026-02-03T01:02:03", "2026-02-03T25:02:03Z"], d=X.utc_timestamp(t).isNotNull())
    assert [g["d"] for g in got] == [True, True, False, False]
    assert [g["r"] for g in run(spark, ["C2004A05138", "C2004A05138\n", "c2004A05138", ""], r=X.is_register_id(t))] == [True, False, False, False]


@pytest.mark.parametrize("act,heading,body,want", [
    ("Income Tax Act", "Rates of things", "", "other"), ("X", "FBT rules", "", "fringe benefits tax"), ("X", "SAFBTS", "", "other"),
    ("Customs Tariff Act", "excise", "", "customs tariff schedules"), ("X", None, "a trust holds", "trusts and partnerships"), ("X", "", "y" * 300 + "medicare", "other")])
def test_topics(spark, act, heading, body, want):
    df = spark.createDataFrame([(act, heading, body)], "a string, h string, b string")
    assert df.select(X.topic_for(F.col("a"), F.col("h"), F.col("b")).alias("x")).first()["x"] == want


def test_ownership(spark):
    texts = ["a 100% subsidiary", "10% stakes", "10%  stake", "Voting interest", "beneficially owned", "30% of tax"]
    assert [g["o"] for g in run(spark, texts, o=X.is_ownership_test(F.col("t")))] == [True, False, False, True, True, False]


def test_names_and_numbers(spark):
    t = F.col("t")
    got = run(spark, ["Wilma Obermoor 12345678 and O’Ray, Tom 123456789", "TAXATION OFFICE", "Taxation Office Act", "McHale Baker-Finch"], n=I.person_names(t), r=I.registration_numbers(t))
    assert got[0]["n"] == ["O’Ray, Tom", "Wilma Obermoor"] and got[0]["r"] == ["12345678"]
    assert got[1]["n"] == [] and got[2]["n"] == [] and got[3]["n"] == ["McHale Baker-Finch"]


def test_contacts(spark):
    texts = [
        "A.B+c@Mail.example, (02) 5550 1234; +61 2 5550 1234; 0412345678; 13 24 68; 1300 123 456",
        "20040728 and $1 300 000 000 and 94 422 042 689",
        "TFN: 123 456 782. tax file number 12345678; bare 123-456-782 and 123 456 789",
        "tax file number 7/2004",
    ]
    got = run(spark, texts, c=I.contact_values(F.col("t")))
    assert [(x["kind"], x["value"]) for x in got[0]["c"]] == [
        ("email", "a.b+c@mail.example"), ("phone", "0255501234"), ("phone", "0255501234"), ("phone", "0412345678"), ("phone", "132468"), ("phone", "1300123456")]
    assert got[1]["c"] == [] and got[3]["c"] == []
    assert [(x["kind"], x["value"]) for x in got[2]["c"]] == [("tfn", "123456782"), ("tfn", "12345678"), ("tfn", "123456782")]
    assert run(spark, ["x"], f=I.fingerprint(F.col("t")))[0]["f"] == hashlib.sha256(b"x").hexdigest()


def test_control_bytes(spark):
    assert [g["b"] for g in run(spark, ["a\tb\r\n\f", "a\x00", "\x85", None, ""], b=I.has_control_bytes(F.col("t")))] == [False, True, True, False, False]
