"""Word and n-gram hashes of whole batches of texts, computed without a Python loop.

A word is an unbroken run of ASCII letters and digits; case is folded. The
texts of a batch lie in one byte buffer (Arrow's own layout). A polynomial
prefix sum over the bytes gives every word's 64-bit hash from its two ends,
and n-gram hashes follow from the word hashes in n vector operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: 0 for a separator, else the lower-case byte.
_FOLD = np.zeros(256, np.uint8)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _FOLD[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _FOLD[_c] = _c + 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^k and base^-k for k < n, modulo 2^64; kept for the worker's life."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, b in (("up", _BASE), ("down", _BASE_INV)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Words:
    """Words of a batch of texts: hash, text index, and the words' range of every text."""

    hash: np.ndarray  # uint64, one per word
    doc: np.ndarray  # int64, index of the word's text
    first: np.ndarray  # int64, words of text i are first[i]:first[i + 1]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word sequences within a text, and the positions they start at."""
        total = len(self.hash) - n + 1
        if total <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        h = self.hash[:total].copy()
        for k in range(1, n):
            h *= _GRAM
            h += self.hash[k : k + total]
        at = np.flatnonzero(self.doc[:total] == self.doc[n - 1 :])
        return mix(h[at]), at


def words(texts: pa.Array | pa.ChunkedArray) -> Words:
    """All words of a batch; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return Words(np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(1, np.int64))
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    lo, hi = int(off[0]), int(off[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.empty(0, np.uint8)
    edge = off - lo
    folded = _FOLD[raw]
    inside = folded != 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = edge[(edge > 0) & (edge < len(raw))]
    begin[cut] = inside[cut]  # a word never crosses from one text into the next
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    stop[cut - 1] = inside[cut - 1]
    b, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(folded.astype(np.uint64) * up[:-1], out=total[1:])
    h = mix((total[e] - total[b]) * down[b] + (e - b).astype(np.uint64))
    first = np.searchsorted(b, edge).astype(np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(first))
    return Words(h, doc, first)


def chunks(batch: pa.RecordBatch, column: str, budget: int = 1 << 19, rows: int = 1 << 16):
    """Slices of a batch of at most `rows` rows whose text is about `budget` bytes, a longer single text alone.

    Bounds a worker's memory whatever the texts' lengths; whole texts only.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    start, size = 0, 0
    for i, k in enumerate(lengths):
        if i > start and (size + k > budget or i - start == rows):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(k)
    if start < len(lengths):
        yield batch.slice(start)
