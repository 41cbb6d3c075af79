"""One consistent form for text that looks the same but differs in its characters.

Method: a transducer over grapheme clusters, compiled once into a trie of code
points, rewrites a text in one pass, always taking the longest match. Its
mapping (widths, styled letters, ligatures, accents, spaces, zero-width signs,
hyphens) follows from the Unicode character database by rule; look-alike
letters of other scripts, which the database does not hold, are listed. The
mapping is checked for conflicts when it is compiled: no input has two
outputs, and every output is stable under the transducer. A cluster that the
trie does not cover as a whole (marks in another order, several marks, Hangul
letters) is mapped sign by sign, ordered by combining class and composed, so
canonically equal texts come out equal.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache, lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin letter.
LOOKALIKE = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "υ": "u", "χ": "x", "γ": "y", "ϲ": "c", "Ϲ": "C", "ϳ": "j",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Һ": "h", "а": "a",
    "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ү": "y", "ӏ": "l",
    "Ӏ": "I", "ѵ": "v", "Ѵ": "V", "Ԍ": "G", "г": "r", "ь": "b", "Ь": "b", "ҽ": "e",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "Օ": "O", "Տ": "S", "Ս": "U", "Լ": "L",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭹ": "Y", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M",
    "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S",
    "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏻ": "G", "Ᏼ": "B",
}
# Signs without width.
ZERO_WIDTH = "­᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"
NO_BREAK_HYPHEN = "‑"

FULL_WIDTH, COMBINING, INVISIBLE, SPACE, HYPHEN, LIGATURE, STYLED, SCRIPT, UNRESOLVED, OTHER_SCRIPT, CANONICAL = (
    "full_width", "combining", "zero_width", "space", "hyphen", "ligature", "styled", "lookalike", "unresolved", "other_script", "canonical",
)
#: What makes a value inconsistent in the sense of `p3_found`; the other classes are canonical variants and scripts beyond Greek and Cyrillic.
REPORTED = (FULL_WIDTH, COMBINING, INVISIBLE, SPACE, HYPHEN, LIGATURE, STYLED, SCRIPT, UNRESOLVED)


def _is_mark(c: str) -> bool:
    return unicodedata.category(c) in ("Mn", "Mc", "Me")


def _kind_by_rule(c: str) -> tuple[str, str] | None:
    """(output, class) of a single code point, by its entry in the character database."""
    tag, _, rest = unicodedata.decomposition(c).partition(" ")
    if c in ZERO_WIDTH:
        return "", INVISIBLE
    if unicodedata.category(c) == "Zs" and c != " ":
        return " ", SPACE
    if c == NO_BREAK_HYPHEN:
        return "-", HYPHEN
    target = unicodedata.normalize("NFKC", c)
    if tag in ("<wide>", "<narrow>"):
        return target, FULL_WIDTH
    if tag == "<font>":
        return target, STYLED
    if tag == "<compat>" and "LIGATURE" in unicodedata.name(c, "") and all(x.isalpha() for x in target) and 0xFB00 <= ord(c) < 0xFB50:
        return target, LIGATURE
    if (same := unicodedata.normalize("NFC", c)) != c:
        return same, COMBINING if _is_mark(c) else CANONICAL
    return None


class Transducer:
    """The compiled mapping: `points` of single signs, `trie` of sequences, `cluster` and `run` to cut a text."""

    def __init__(self) -> None:
        """Raises ValueError on a conflict."""
        self.points: dict[str, tuple[str, str]] = {}
        sequences: dict[str, tuple[str, str]] = {}
        # what joins the sign before it: marks, Hangul vowels and finals (by rule), second parts of composed letters
        extend = {chr(k) for r in (range(0x1161, 0x1176), range(0x11A8, 0x11C3)) for k in r}
        for k in range(128, sys.maxunicode + 1):
            c = chr(k)
            if unicodedata.category(c) in ("Cs", "Co", "Cn"):
                continue
            if rule := _kind_by_rule(c):
                self.points[c] = rule
            if _is_mark(c):
                extend.add(c)
            apart = unicodedata.normalize("NFD", c)
            if len(apart) > 1 and not 0xAC00 <= k <= 0xD7A3 and unicodedata.normalize("NFC", apart) == c:
                extend.update(apart[1:])
                if not _is_mark(c) and sequences.setdefault(apart, (c, COMBINING))[0] != c:
                    raise ValueError(f"two outputs for {apart!a}")
        extend.update(c for c, (out, kind) in self.points.items() if kind == INVISIBLE or out[:1] in extend)
        self.trie: dict = {}
        for source, value in [*self.points.items(), *sequences.items()]:
            node = self.trie
            for c in source:
                node = node.setdefault(c, {})
            if node.setdefault("", value) != value:
                raise ValueError(f"two outputs for {source!a}")
        codes = sorted(map(ord, extend))
        edges = [(a, b) for i, a in enumerate(codes) if i == 0 or codes[i - 1] != a - 1 for b in [self._end(codes, i)]]
        self.extend = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in edges)
        self.cluster = re.compile(f"(?s).[{self.extend}]*")
        for source, (out, _) in [*self.points.items(), *sequences.items()]:
            if out and "".join(self.form(x)[0] for x in self.cluster.findall(out)) != out:
                raise ValueError(f"the output for {source!a} is not stable")

    @staticmethod
    def _end(codes: list[int], i: int) -> int:
        while i + 1 < len(codes) and codes[i + 1] == codes[i] + 1:
            i += 1
        return codes[i]

    def form(self, cluster: str) -> tuple[str, frozenset]:
        """A cluster's one form and the classes found in it: the longest match of the trie, or sign by sign."""
        node = self.trie
        for c in cluster:
            node = node.get(c)
            if node is None:
                break
        if node and "" in node:
            return node[""][0], frozenset([node[""][1]])
        found = {self.points[c][1] for c in cluster if c in self.points}
        mapped = "".join(self.points[c][0] if c in self.points else c for c in cluster)
        out = unicodedata.normalize("NFC", mapped)  # marks by combining class, then composed; Hangul by rule
        if any(not c.isascii() and _is_mark(c) for c in cluster):
            found.add(COMBINING)
        elif out != mapped:
            found.add(CANONICAL)
        return out, frozenset(found)


@cache
def compiled() -> Transducer:
    return Transducer()


@lru_cache(maxsize=1 << 14)
def _formed(cluster: str) -> tuple[str, frozenset]:
    return compiled().form(cluster)


@lru_cache(maxsize=1 << 14)
def _script(c: str) -> str:
    """latin, other (Greek or Cyrillic), look (another script with look-alike letters) or an empty string."""
    if c.isascii():
        return "latin" if c.isalpha() else ""
    if not c.isalpha():
        return ""
    name = unicodedata.name(c, "")
    if name.startswith("LATIN "):
        return "latin"
    return "other" if name.startswith(("GREEK ", "CYRILLIC ")) else "look" if name.startswith(("ARMENIAN ", "CHEROKEE ")) else ""


#: A stretch of signs without ASCII blanks that holds anything beyond ASCII; all else is copied as it stands.
_RUN = re.compile(r"(?<![!-~])[!-~]*+(?:[^\x00-\x7f][!-~]*+)++")


def rewrite(text: str, label: bool = False) -> tuple[str, frozenset]:
    """The consistent form of a text and the classes that were found in it.

    In a label every Greek or Cyrillic letter counts and is replaced where a
    Latin letter looks like it; in running text only within a word that also
    has Latin letters, and so do Armenian and Cherokee letters in either.
    Whole words of another script stay. A Greek or Cyrillic letter that no
    Latin letter looks like stays and is `unresolved`.
    """
    if text.isascii():
        return text, frozenset()
    clusters = compiled().cluster.findall
    found: set[str] = set()

    def run(m: re.Match) -> str:
        out: list[str] = []
        word: list[str] = []
        scripts: set[str] = set()

        def flush() -> None:
            if len(scripts) > 1 and "latin" in scripts or (label and "other" in scripts):
                for i, c in enumerate(word):
                    base = unicodedata.normalize("NFD", c)
                    which = _script(base[0])
                    if which not in ("other", "look"):
                        continue
                    like = LOOKALIKE.get(base[0])
                    if like:
                        word[i] = unicodedata.normalize("NFC", like + base[1:])
                    if which == "other":
                        found.add(SCRIPT if like else UNRESOLVED)
                    elif like:
                        found.add(OTHER_SCRIPT)
            out.extend(word)
            word.clear()
            scripts.clear()

        for c in clusters(m.group()):
            if c.isascii():
                piece = c
            else:
                piece, kinds = _formed(c)
                found.update(kinds)
            # a cluster can come out as several signs (ligatures); its marks stay with their letter
            for x in clusters(piece) if len(piece) > 1 else piece:
                if x[0].isalnum() or (not x[0].isascii() and _is_mark(x[0])):
                    word.append(x)
                    if sc := _script(x[0]):
                        scripts.add(sc)
                else:
                    flush()
                    out.append(x)
        flush()
        return "".join(out)

    return _RUN.sub(run, text), frozenset(found)


def consistent(text: str | None, label: bool = False) -> tuple[str | None, frozenset]:
    """rewrite(); a label also loses outer white space. Null stays null."""
    if text is None:
        return None, frozenset()
    done, found = rewrite(text, label)
    return (done.strip() if label else done), found


def normalise(df: DataFrame, key: str, fields: dict[str, bool]) -> DataFrame:
    """(key, each field rewritten, <field>_found) of every row; fields maps a name to whether it is a label.

    <field>_found is a sorted array of the classes found, empty if the value
    was consistent already. ASCII values pass through Arrow untouched, labels but for outer white space. Null
    stays null; repeated keys give repeated rows; other columns are ignored.
    """
    names = list(fields)
    src = df.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_f{i}") for i, c in enumerate(names)])
    key_type = src.schema["_key"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            cols = [batch.column(0)]
            for i, label in enumerate(fields.values()):
                a = batch.column(i + 1)
                odd = pc.invert(pc.fill_null(pc.string_is_ascii(a), True))
                done = [consistent(x, label) for x in a.filter(odd).to_pylist()]
                none = pa.scalar([], pa.list_(pa.string()))
                found = pa.array([sorted(f) for _, f in done], pa.list_(pa.string()))
                plain = pc.utf8_trim_whitespace(a) if label else a
                cols.append(pc.replace_with_mask(plain, odd, pa.array([x for x, _ in done], a.type)))
                where = odd.to_pylist()
                it = iter(found)
                cols.append(pa.array([next(it).as_py() if o else none.as_py() for o in where], pa.list_(pa.string())) if any(where) else pa.array([[]] * len(a), pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(cols, names=["_key", *(x for i in range(len(names)) for x in (f"_f{i}", f"_c{i}"))])

    schema = f"_key {key_type}, " + ", ".join(f"_f{i} string, _c{i} array<string>" for i in range(len(names)))
    out = src.mapInArrow(work, schema)
    return out.select(
        F.col("_key").alias(key),
        *[x for i, c in enumerate(names) for x in (F.col(f"_f{i}").alias(c), F.col(f"_c{i}").alias(f"{c}_found"))],
    )


def not_ascii(*columns: str):
    """A JVM-side filter for rows that may need work."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.coalesce(F.col(c).rlike(r"[^\x00-\x7F]"), F.lit(False))
    return cond
