"""Splitting, look-alikes and personal information."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabularium.llm import lookalikes as la
from tabularium.llm import personal as pi
from tabularium.llm.splitting import boundary_class, split, split_oversized


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .;\n\r\t", max_size=400), st.integers(20, 60), st.integers(0, 9))
def test_pieces_fit_overlap_and_cover(text, limit, overlap):
    pieces = split(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and pieces[-1][2] == "end"
    for s, e, _ in pieces:
        assert e - s <= limit
    for (_, e, _), (s, e2, _) in zip(pieces, pieces[1:]):
        assert e - s == overlap and e2 > e


def test_natural_boundaries_are_preferred():
    para = "x" * 40 + "\n\n"
    assert {k for _, _, k in split(para * 10, 100, 5)} <= {"paragraph", "end"}
    assert {k for _, _, k in split(("y" * 40 + ". ") * 10, 100, 5)} <= {"sentence", "end"}
    assert {k for _, _, k in split("z" * 500, 100, 5)} == {"none", "end"}
    assert {k for _, _, k in split("word " * 100, 100, 5)} <= {"word", "end"}


def test_boundary_classes():
    assert boundary_class("a" * 50 + "\r\n\r\n" + "b" * 50, 50) == "paragraph"
    assert boundary_class("a" * 50 + "\r\n" + "b" * 50, 50) == "line"
    assert boundary_class("a" * 49 + "? " + "b" * 50, 50) == "sentence"
    assert boundary_class("a" * 49 + ", " + "b" * 50, 50) == "none"


def test_split_operator_on_odd_rows(spark):
    long = "Sentence one is here. " * 300
    rows = [("r1", None, long, 1), ("r1", None, long, 2), (None, "s", "short", 3), ("r3", "s", None, 4), ("r4", "", "", 5)]
    df = spark.createDataFrame(rows, "row_id string, section string, text string, piece int")
    got = split_oversized(df, "text", ["row_id", "section"]).collect()
    assert [x["piece_text"] for x in got if x["row_id"] is None] == ["short"]
    assert not [x for x in got if x["row_id"] == "r3"]
    assert [x["piece_text"] for x in got if x["row_id"] == "r4"] == [""]
    one = sorted({(x["piece"], x["start"], x["end"], x["piece_text"]) for x in got if x["row_id"] == "r1"})
    assert sum(1 for x in got if x["row_id"] == "r1") == 2 * len(one)
    assert "".join(t[200 * (i > 0) :] for i, (_, _, _, t) in enumerate(one)) == long
    assert split_oversized(df.limit(0), "text", ["row_id"]).collect() == []
    with pytest.raises(ValueError):
        split_oversized(df, "text", ["row_id"], 100, 60)


CASES = {
    "ＡＢ１": ("AB1", "full_width"),
    "étude": ("étude", "combining"),
    "a​b﻿": ("ab", "zero_width"),
    "re­turn": ("return", "zero_width"),
    "a b c": ("a b c", "space"),
    "tax‑free": ("tax-free", "hyphen"),
    "oﬃce": ("office", "ligature"),
    "\U0001d41a\U0001d5bb": ("ab", "styled"),
    "quаrter": ("quarter", "lookalike"),
}


@pytest.mark.parametrize("text", list(CASES))
def test_characters_that_look_alike(text):
    want, kind = CASES[text]
    assert la.consistent(text) == (want, frozenset([kind]))
    assert la.consistent(want) == (want, frozenset())


@pytest.mark.parametrize("text", ["café", "φόρος", "налог", "β exceeds", "“x” – y — z", "40 m²", "½", "€5 ≥ §", "", "plain"])
def test_what_stays(text):
    assert la.consistent(text) == (text, frozenset())


def test_labels():
    assert la.consistent("9ZΑ", True) == ("9ZA", frozenset(["lookalike"]))
    assert la.consistent("20-325　", True) == ("20-325", frozenset(["space"]))
    assert la.consistent("5К", True)[0] == "5K"
    assert la.consistent(None, True) == (None, frozenset())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAeо́̈é​ Ａﬁβνx1 -", max_size=25), st.booleans())
def test_the_form_is_stable(text, label):
    once, _ = la.consistent(text, label)
    assert la.consistent(once, label)[0] == once


def test_normalise_operator(spark):
    rows = [("a", "１", "x y", 1), ("a", "１", "x y", 1), (None, None, None, 2), ("b", "2", "", 3), ("c", "3", "z" * 200_000 + "​", 4)]
    df = spark.createDataFrame(rows, "k string, section string, text string, section_found int")
    got = la.normalise(df, "k", {"section": True, "text": False}).collect()
    assert sorted((x["k"], x["section"], tuple(x["section_found"]), len(x["text"])) for x in got if x["k"]) == [
        ("a", "1", ("full_width",), 3), ("a", "1", ("full_width",), 3), ("b", "2", (), 0), ("c", "3", (), 200_000)]
    assert [x for x in got if x["k"] is None][0]["text"] is None
    assert la.normalise(df.limit(0), "k", {"text": False}).collect() == []


FOUND = [
    ("Write to ann_lee+x@mail.example or ring 0491 570 156.", {("email", "ann_lee+x@mail.example"), ("phone", "0491 570 156")}),
    ("at jo.ray (at) post (dot) example (dot) org before", {("email", "jo.ray (at) post (dot) example (dot) org")}),
    ("ring (02) 5550 1234 or +61 (0)2 5550 1234 or 1800 160 401", {("phone", "(02) 5550 1234"), ("phone", "+61 (0)2 5550 1234"), ("phone", "1800 160 401")}),
    ("The certificate was issued to Ms Wilma K. Obermoor, passport N5937381, on", {("name", "Wilma K. Obermoor"), ("idnumber", "N5937381")}),
    ("The delegates are OBERMOOR, Wilma and T. McHale-Ray.", {("name", "OBERMOOR, Wilma"), ("name", "T. McHale-Ray")}),
    ("tax file number 005 042 196 here", {("idnumber", "005 042 196")}),
    ("Receipt 006 409 702 was cancelled. The folio is 27756571 and the file is 75799245.", set()),
    ("Quote registered agent no 78865680 when", {("idnumber", "78865680")}),
    ("| Wilma Obermoor | 36735779 | North Cordale |", {("name", "Wilma Obermoor"), ("idnumber", "36735779")}),
    ("from Unit 1/254 Pine Rd, Mount Ash EV 9100 on 1 May 2003", {("address", "Unit 1/254 Pine Rd, Mount Ash EV 9100")}),
    ("at 202C Pine Avenue\nLower Ash CP 9140.", {("address", "202C Pine Avenue\nLower Ash CP 9140")}),
    ("premises at 117 Pine Lane are bonded", {("address", "117 Pine Lane")}),
    ("The Deputy Commissioner and the Excise Review Panel; $858 416 151; 12 May 2010", set()),
    ("Obermoor Holdings Pty Ltd, business number 94 422 042 689, is exempt.", set()),
]


@pytest.mark.parametrize("text,want", FOUND)
def test_personal_items(text, want):
    assert {(k, text[s:e]) for s, e, k in pi.spans(text)} == want


def test_check_digit_against_its_definition():
    r = random.Random(1)
    for _ in range(200):
        d = f"{r.randrange(10**9):09d}"
        assert pi.plausible_tfn(d) == (sum(w * int(x) for w, x in zip(pi.TFN_WEIGHTS, d)) % 11 == 0)
    assert not pi.plausible_tfn("12345678")


def test_redaction_keeps_the_rest():
    text = FOUND[0][0]
    assert pi.redact(text) == "Write to [EMAIL] or ring [PHONE]."
    assert pi.redact(None) is None and pi.redact("") == ""


def test_personal_operators(spark):
    rows = [("a", FOUND[0][0], "x"), ("a", FOUND[0][0], "x"), (None, FOUND[3][0], "y"), ("c", None, "z"), ("d", "", "z"), ("e", "9" * 300_000 + " A" * 50_000, "z")]
    df = spark.createDataFrame(rows, "k string, t string, kind string")
    got = pi.find_personal(df, "k", "t").collect()
    assert len([x for x in got if x["k"] == "a"]) == 4 and len([x for x in got if x["k"] is None]) == 2
    red = {x["k"]: x for x in pi.redact_personal(df, "k", "t").collect()}
    assert red["c"]["t"] is None and red["d"]["t"] == "" and red["a"]["items"] == 2
    assert re.search(r"\[NAME\], passport \[IDNUMBER\]", red[None]["t"])
    assert pi.find_personal(df.limit(0), "k", "t").collect() == []


MORE = [
    ("Mr Peter Hill attended.", {("name", "Peter Hill")}),
    ("She met Maria Schmidt yesterday", {("name", "Maria Schmidt")}),
    ("The Mount Hill reserve and Peter Hill", set()),
    ("Pay with 4111 1111 1111 1111 today", {("card", "4111 1111 1111 1111")}),
    ("Pay with 4111 1111 1111 1112 today", set()),
    ("to GB82 WEST 1234 5698 7654 32 or DE89370400440532013000.", {("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000")}),
    ("to GB82 WEST 1234 5698 7654 33", set()),
    ("Ring +49 30 12345678 or +44 (20) 7946 0958 now", {("phone", "+49 30 12345678"), ("phone", "+44 (20) 7946 0958")}),
]


@pytest.mark.parametrize("text,want", MORE)
def test_validated_numbers_and_names_without_cue(text, want):
    assert {(k, text[s:e]) for s, e, k in pi.spans(text)} == want


def test_validators_against_their_definitions():
    r = random.Random(2)
    for _ in range(200):
        d = "".join(r.choice("0123456789") for _ in range(r.randrange(13, 20)))
        doubled = [int(x) * (2 if (len(d) - 1 - i) % 2 else 1) for i, x in enumerate(d)]
        assert pi.luhn(d) == (sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0)
    assert pi.luhn("4111111111111111") and not pi.luhn("411")
    good = "GB82WEST12345698765432"
    assert pi.mod97(good) and not any(pi.mod97(good[:i] + str((int(c) + 1) % 10) + good[i + 1 :]) for i, c in enumerate(good) if c.isdigit())


def test_scanning_is_linear_in_the_text():
    import time

    for unit in ("Ann Lee-Ray, 12345678; ", "12 Ash Rd, ", "a@b.example ", "1 2 3 4 ", "A"):
        times = []
        for n in (2_000, 8_000):
            began = time.perf_counter()
            pi.spans(unit * n)
            times.append(time.perf_counter() - began)
        assert times[1] < 10 * times[0] + 0.05


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAqeео̧̱̣̇̀́̈가각ÅÅé​ Ａﬁ≠ｶﾞ x1", max_size=20), st.booleans())
def test_canonically_equal_texts_come_out_equal(text, label):
    import unicodedata

    want = la.consistent(text, label)[0]
    for form in ("NFC", "NFD"):
        assert la.consistent(unicodedata.normalize(form, text), label)[0] == want
    assert la.consistent(want, label)[0] == want


@pytest.mark.parametrize("text,want,kind", [("5Ԍ", "5G", "lookalike"), ("5Ж", "5Ж", "unresolved"), ("Ꭰog", "Dog", "other_script"), ("한", "한", "canonical"), ("≠", "≠", "combining")])
def test_classes_beyond_the_reported_ones(text, want, kind):
    assert la.consistent(text, True) == (want, frozenset([kind]))


def test_one_pass_is_linear():
    import time

    began = time.perf_counter()
    la.rewrite("x" * 1_000_000 + " é")
    la.rewrite("á" * 100_000)
    assert time.perf_counter() - began < 5
