"""Cutting oversized texts into overlapping pieces at natural boundaries.

Method: dynamic programming over boundary positions. The end of every piece
but the last lies on a boundary; its cost is the boundary's penalty plus the
piece's squared deviation from an even size, under the length limit and with
a fixed overlap between neighbours. The cheapest sequence of ends is found in
one left-to-right pass, looking back at most one piece length. The same
programme, allowed boundaries of one kind only, says whether the limit can be
kept with them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 3000
OVERLAP = 200

_BLANK = re.compile(r"\r?\n(?:[ \t]*\r?\n)+")
_LINE = re.compile(r"[\r\n]+")
_SENTENCE = re.compile(r"[\r\n]+|(?<=[.;:?])\s+")
_WORD = re.compile(r"\s+")

#: Penalty of a cut by kind; the imbalance of a piece costs at most 1.
PENALTY = {"paragraph": 0.0, "line": 1.0, "sentence": 2.0, "word": 8.0, "none": 40.0}


_CLASSES = (("paragraph", _BLANK), ("line", _LINE), ("sentence", _SENTENCE))


def cheapest(begin: np.ndarray, end: np.ndarray, penalty: np.ndarray, limit: int, even: float) -> list[int] | None:
    """The ends, as indices, of the cheapest sequence of pieces that covers a text; None if there is none.

    A cut at boundary k ends a piece at end[k] and starts the next one at
    begin[k]; both ascend, the last end is the text's and the first piece
    starts at 0. Pieces have at most `limit` characters. Of equal costs the
    earlier cut is taken.
    """
    n = len(end)
    best = np.full(n, np.inf)
    came = np.full(n, -2, np.int64)
    low = np.searchsorted(begin, end - limit)  # the first cut that the piece up to each end can follow
    for i in range(n):
        e = end[i]
        if e <= limit:  # a first piece
            best[i], came[i] = penalty[i] + ((e - even) / limit) ** 2, -1
        k = low[i]
        if k < i:
            cost = best[k:i] + ((e - begin[k:i] - even) / limit) ** 2
            cost[begin[k:i] <= 0] = np.inf
            at = int(np.argmin(cost))
            if cost[at] + penalty[i] < best[i]:
                best[i], came[i] = cost[at] + penalty[i], k + at
    if not n or not np.isfinite(best[-1]):
        return None
    ends = [n - 1]
    while came[ends[-1]] >= 0:
        ends.append(int(came[ends[-1]]))
    return ends[::-1]


def boundary_class(text: str, limit: int) -> str:
    """The first of paragraph, line, sentence whose cuts alone keep the limit, else none.

    The programme runs without overlap, and what separates two stretches
    belongs to neither.
    """
    for name, pattern in _CLASSES:
        spans = [m.span() for m in pattern.finditer(text)]
        end = np.array([a for a, _ in spans] + [len(text)], np.int64)
        begin = np.array([b for _, b in spans] + [len(text)], np.int64)
        # separators at the very start leave an empty first stretch; it is no cut
        if cheapest(np.maximum(begin, 1), end, np.zeros(len(end)), limit, limit) is not None:
            return name
    return "none"


def _positions(text: str, reach: int) -> tuple[list[int], dict[int, str]]:
    """Sorted cut positions; finer kinds are added only where a gap between coarser ones is wider than `reach`."""
    kind: dict[int, str] = {}
    for name, pattern in (("sentence", _SENTENCE), ("line", _LINE), ("paragraph", _BLANK)):
        for m in pattern.finditer(text):
            kind[m.end()] = name
    kind.pop(0, None)
    kind[len(text)] = "end"
    last = 0
    for p in sorted(kind):
        if p - last > reach:
            for m in _WORD.finditer(text, last, p):
                kind.setdefault(m.end(), "word")
        last = p
    last = 0
    for p in sorted(kind):
        for q in range(last + reach, p, reach):
            kind.setdefault(q, "none")
        last = p
    kind.pop(0, None)
    return sorted(kind), kind


def split(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """(start, end, kind of the cut at the end) of the pieces; the last piece's kind is `end`."""
    if len(text) <= limit:
        return [(0, len(text), "end")]
    step = limit - overlap
    # with cut positions at most half a step apart, the next end can always be reached
    at, kind = _positions(text, max(1, step // 2))
    even = len(text) / -(-(len(text) - overlap) // step) + overlap / 2
    end = np.array(at, np.int64)
    ends = cheapest(end - overlap, end, np.array([PENALTY.get(kind[e], 0.0) for e in at]), limit, even)
    starts = [0, *(at[k] - overlap for k in ends[:-1])]
    return [(s, at[k], kind[at[k]]) for s, k in zip(starts, ends)]


def split_oversized(df: DataFrame, text: str, keep: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces (keep..., piece, start, end, cut, boundary, piece_text) of every row.

    Pieces are numbered from 0; start and end are code point offsets; end of
    one piece minus start of the next is `overlap`. A text within the limit is
    one piece, made without leaving the JVM, with boundary null; an empty text
    is one empty piece and a null text none. Repeated rows give repeated
    pieces. `boundary` is the coarsest kind of stretch that fits the limit.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be under half the limit")
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    names = [f"_k{i}" for i in range(len(keep))]
    src = df.select(*kept, F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    short = src.where(F.char_length("_text") <= limit).select(
        *names,
        F.lit(0).alias("piece"),
        F.lit(0).alias("start"),
        F.char_length("_text").alias("end"),
        F.lit("end").alias("cut"),
        F.lit(None).cast("string").alias("boundary"),
        F.col("_text").alias("piece_text"),
    )

    return short.unionByName(_cut(src, names, limit, overlap)).withColumnsRenamed(dict(zip(names, keep)))


def split_long(df: DataFrame, text: str, keep: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """split_oversized() for the texts over the limit only; the others have no pieces."""
    names = [f"_k{i}" for i in range(len(keep))]
    src = df.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_text"))
    return _cut(src, names, limit, overlap).withColumnsRenamed(dict(zip(names, keep)))


def _cut(src: DataFrame, names: list[str], limit: int, overlap: int) -> DataFrame:
    types = [src.schema[n].dataType.simpleString() for n in names]

    def cut(batches):
        for batch in batches:
            take: list[int] = []
            rows: list[tuple] = []
            for i, t in enumerate(batch.column(len(names)).to_pylist()):
                cls = boundary_class(t, limit)
                for k, (s, e, kind) in enumerate(split(t, limit, overlap)):
                    take.append(i)
                    rows.append((k, s, e, kind, cls, t[s:e]))
            cols = [batch.column(j).take(pa.array(take, pa.int64())) for j in range(len(names))]
            made = list(zip(*rows)) or [()] * 6
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(v, t) for v, t in zip(made, kinds)],
                names=[*names, "piece", "start", "end", "cut", "boundary", "piece_text"],
            )

    schema = ", ".join([*(f"`{n}` {t}" for n, t in zip(names, types)), "piece int, start int, end int, cut string, boundary string, piece_text string"])
    return src.where(F.char_length("_text") > limit).mapInArrow(cut, schema)
