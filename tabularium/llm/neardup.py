"""Near-duplicate texts: every pair above a Jaccard threshold, and their groups.

Method: universe-partition pigeonhole. A text is the set of its shingles.
Texts are put into bands by size; per band the universe of shingles is hashed
into segments. Jaccard above t bounds how many shingles of a text its partner
can lack, and their symmetric difference; both follow from the sizes. Per band
one of two indexes is allocated, whichever costs less by an estimate from
statistics over all documents (entries to ship plus meetings to look at):

* subsets: of every text the cheapest shingles (rarest in the corpus, by an
  order all texts share) are taken, as many as make sure that two similar
  texts have g + k of them in common, g being the band's segments; by
  pigeonhole they then share k two-shingle subsets within segments. Those
  subsets are the index.
* neighbourhoods: the band has so many segments that two similar texts differ
  by at most one shingle in k of them; the index holds every segment's whole
  content and its one-deletion neighbourhood, and a meeting needs at least one
  whole content.

Index entries are exchanged by their hash, so a task sees an even share of
them whatever a group's or a key's size. Pairs that meet k times are verified
exactly on their full shingle sets.

A pair of texts meets in the band of the larger one: a text enters its own
band, and the next band if it can have partners there. Copies have equal sets
and are one class up to the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.vectors import summed
from tabularium.llm.words import chunks, mix, words
from tabularium.session import discard, materialise
from tabularium.sources.bitmaps import bitmap

SHINGLE = 5
THRESHOLD = (4, 5)
LEAST_THRESHOLD = 1 / 4  # below it a small text's share of segments could be empty
MEETINGS = 2  # k: common index entries that a similar pair has at least
FIRST_BAND = 16  # shingles; smaller sets share the first band, whose index is single shingles
BAND_RATIO = 2.78
SEGMENTS = 0.35  # segments per shingle of the smallest set of a band, in the index of subsets
MEETING_COST = 1.0  # of a meeting, in entries
BANDS = 32
SKETCH = 1 << 20
CHUNK = 1 << 22
CHUNK_ROWS = 1 << 12

_TOKEN_BITS = 44
_DOC_BITS = 12  # CHUNK_ROWS
_SEG_BITS = 16
_SIG_BITS = 28  # of an entry's hash beyond what chose its partition
_TAG_BITS = 35  # of the text's class; equal tags are told apart later, by the classes that have them
_EDGES = np.array([1] + [int(np.ceil(FIRST_BAND * BAND_RATIO**j)) for j in range(BANDS - 1)], np.int64)


def _sets(texts: pa.Array, shingle: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (44-bit hashes) sorted by (text, shingle), and their text; texts of fewer words have none.

    Words are hashed in chunks of bounded bytes, as that takes many times the texts' memory.
    """
    tokens, docs, before = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    for part in chunks(pa.record_batch([texts], ["text"]), "text"):
        w = words(part.column(0))
        g, at = w.grams(shingle)
        doc = w.doc[at]
        long = np.diff(w.first)[doc] >= least_words
        key = (doc[long].astype(np.uint64) << np.uint64(_TOKEN_BITS)) | (g[long] >> np.uint64(64 - _TOKEN_BITS))
        key.sort()
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        key = key[fresh]
        tokens.append(key & np.uint64((1 << _TOKEN_BITS) - 1))
        docs.append((key >> np.uint64(_TOKEN_BITS)).astype(np.int64) + before)
        before += part.num_rows
    return np.concatenate(tokens), np.concatenate(docs)


def _starts(x: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return np.flatnonzero(fresh)


def _band(size: np.ndarray) -> np.ndarray:
    return np.maximum(np.searchsorted(_EDGES, size, side="right") - 1, 0)


def _overlap(n: np.ndarray, other: np.ndarray, num: int, den: int) -> np.ndarray:
    """The fewest common elements of similar sets of n and `other` elements."""
    return -((-num * (n + other)) // (num + den))


def _segments(band: np.ndarray, num: int, den: int) -> np.ndarray:
    """Segments of a band in the index of subsets: few enough that the smallest similar sets still share g + k elements."""
    low = _EDGES[band]
    return np.clip((SEGMENTS * low).astype(np.int64), 1, np.clip(low * num // den - MEETINGS, 1, (1 << _SEG_BITS) - 1))


def _whole_segments(band: np.ndarray, num: int, den: int) -> np.ndarray:
    """Segments of a band in the index of neighbourhoods: k of them differ by at most one element."""
    most = 2 * (_EDGES[np.minimum(band + 1, BANDS - 1)] - 1) * (den - num) // (den + num)
    return most // 2 + MEETINGS


def allocation(sketch: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Per band whether neighbourhoods are allocated (else subsets), by the cheaper estimate.

    `sketch` counts all texts' shingles by hash, `sizes` the texts of each
    band. A text costs its entries plus the texts it is expected to meet, if
    shingles occurred independently of each other at their sketch's rates.
    """
    texts = max(float(sizes.sum()), 1.0)
    cells = np.sort(sketch[sketch > 0].astype(float))
    out = np.zeros(BANDS, bool)
    if not len(cells):
        return out
    mass = np.cumsum(cells) / cells.sum()
    for b in np.flatnonzero(sizes[1:]) + 1:
        n = int(np.sqrt(float(_EDGES[b]) * float(_EDGES[min(b + 1, BANDS - 1)])))
        g = int(_segments(np.array([b]), num, den)[0])
        prefix = min(n, n - int(_overlap(n, -(-n * num // den), num, den)) + g + MEETINGS)
        # the frequency of each of the text's shingles, rarest first
        often = np.minimum(cells[np.minimum(np.searchsorted(mass, (np.arange(n) + 0.5) / n), len(cells) - 1)], texts)
        subsets = prefix**2 / (2 * g) + MEETING_COST * often[:prefix].sum() ** 2 / (2 * g * texts)
        m = int(_whole_segments(np.array([b]), num, den)[0])
        per, rate = n / m, float((often / texts).mean())
        # contents by size (Poisson): j shingles agree at rate^j, all empty ones agree
        j = np.arange(0, int(4 * per) + 8)
        p = np.exp(-per + j * np.log(per) - np.cumsum(np.log(np.maximum(j, 1))))
        whole = m + n + MEETING_COST * texts * m * float((p * (rate**j + j * rate ** np.maximum(j - 1, 0)) * np.where(j == 0, np.exp(-per), 1.0)).sum())
        out[b] = whole < subsets
    return out


def steps(sketch: np.ndarray) -> np.ndarray:
    """The sketch's counts in 256 logarithmic steps."""
    return np.minimum(8 * np.log2(np.maximum(sketch, 1)), 255).astype(np.uint8)


def _subset_entries(token: np.ndarray, doc: np.ndarray, rank: np.ndarray, need: np.ndarray, band: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the two-shingle subsets within segments of every text's `need` cheapest shingles."""
    use = rank < need[doc]
    t, d = token[use], doc[use]
    h = mix(t + np.uint64(7))
    seg = (h & np.uint64(0xFFFFFF)) % g[d].astype(np.uint64)
    # sorted as one word (text, segment, hash), so all texts order a segment's shingles alike
    low = np.uint64(64 - _DOC_BITS - _SEG_BITS)
    word = (d.astype(np.uint64) << np.uint64(64 - _DOC_BITS)) | (seg << low) | (h >> (np.uint64(64) - low))
    word.sort()
    place = word >> low
    h = word & ((np.uint64(1) << low) - np.uint64(1))
    a, b = _pairs_within(place)
    at = place[a]
    d = (at >> np.uint64(_SEG_BITS)).astype(np.int64)
    salt = (band[d].astype(np.uint64) << np.uint64(_SEG_BITS)) | (at & np.uint64((1 << _SEG_BITS) - 1))
    return d, mix(mix(h[a] * np.uint64(3) + h[b]) + salt)


def _single_entries(token: np.ndarray, doc: np.ndarray, rank: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first band: single shingles, entered k times over, so that one in common is enough."""
    use = rank < need[doc]
    t, d = token[use], doc[use]
    return np.tile(d, MEETINGS), np.concatenate([mix(mix(t + np.uint64(11)) + np.uint64(k)) for k in range(MEETINGS)])


def _whole_entries(token: np.ndarray, doc: np.ndarray, use: np.ndarray, band: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, whole) of every segment's content and one-deletion neighbourhood, empty segments included."""
    of = use[doc]
    t, d = token[of], doc[of]
    m = _whole_segments(band, num, den)
    h = mix(t + np.uint64(7))
    seg = ((h >> np.uint64(32)) % m[d].astype(np.uint64)).astype(np.int64)
    # every text has all its band's segments, so that two empty ones meet
    texts = np.flatnonzero(use)
    count = m[texts]
    first = np.zeros(len(use), np.int64)
    first[texts] = np.cumsum(count) - count
    content = np.zeros(int(count.sum()), np.uint64)
    at = first[d] + seg
    np.add.at(content, at, h)
    owner = np.repeat(texts, count)
    salt = mix(((np.arange(len(content)) - first[owner]) * BANDS + band[owner]).astype(np.uint64))
    return (
        np.concatenate([owner, d]),
        np.concatenate([mix(content + salt), mix(content[at] - h + salt[at])]),
        np.concatenate([np.ones(len(owner), bool), np.zeros(len(d), bool)]),
    )


def entries(token: np.ndarray, doc: np.ndarray, sketch: np.ndarray, whole: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, whole content) of all index entries of a chunk's sets.

    Texts are numbered from 0 without gaps, below CHUNK_ROWS; `sketch` has the steps of steps().
    """
    if not len(token):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    begin = _starts(doc)
    n = np.diff(np.append(begin, len(doc)))
    # the order of cost that all texts share: rare first in 256 steps, ties by hash; doc is sorted and stays as it is
    seen = sketch[(token % np.uint64(len(sketch))).astype(np.int64)].astype(np.uint64)
    word = (doc.astype(np.uint64) << np.uint64(64 - _DOC_BITS)) | (seen << np.uint64(_TOKEN_BITS)) | token
    word.sort()
    token = word & np.uint64((1 << _TOKEN_BITS) - 1)
    rank = np.arange(len(token)) - np.repeat(begin, n)
    own = _band(n)
    out = []
    for band, partner in ((own, -(-n * num // den)), (own + 1, None)):
        if partner is None:
            partner = _EDGES[np.minimum(band, BANDS - 1)]
            use = (partner * num <= n * den) & (band < BANDS)
            band = np.minimum(band, BANDS - 1)
        else:
            use = np.ones(len(n), bool)
        lacking = n - _overlap(n, partner, num, den)
        first = use & (band == 0)
        if first.any():
            d, h = _single_entries(token, doc, rank, np.where(first, lacking + 1, 0))
            out.append((d, h, np.ones(len(d), bool)))
        some = use & (band > 0) & ~whole[band]
        if some.any():
            g = _segments(band, num, den)
            d, h = _subset_entries(token, doc, rank, np.where(some, lacking + g + MEETINGS, 0), band, g)
            out.append((d, h, np.ones(len(d), bool)))
        some = use & (band > 0) & whole[band]
        if some.any():
            out.append(_whole_entries(token, doc, some, band, num, den))
    return tuple(np.concatenate(x) for x in zip(*out))


def _pairs_within(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a, b), a before b, within runs of equal values of a sorted array."""
    begin = _starts(group)
    size = np.diff(np.append(begin, len(group)))
    after = np.repeat(begin + size, size) - np.arange(len(group)) - 1
    a = np.repeat(np.arange(len(group)), after)
    k = np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
    return a, a + 1 + k


def partitions_for(shingles: int) -> int:
    """Partitions of the exchange for so many shingles: about 8 MB of entries each, up to 256 MB beyond 10,000 partitions."""
    size = 8 * shingles
    return min(size >> 23, max(10_000, size >> 28))


def packed(doc: np.ndarray, h: np.ndarray, whole: np.ndarray, tag: np.ndarray, partitions: int):
    """(partition, entries as bytes) of a chunk: sorted words (hash, class tag, whole content), as differences by byte planes."""
    to = ((h & np.uint64((1 << (64 - _SIG_BITS)) - 1)) % np.uint64(partitions)).astype(np.uint16 if partitions < 1 << 16 else np.uint32)
    word = ((h >> np.uint64(64 - _SIG_BITS)) << np.uint64(64 - _SIG_BITS)) | (tag[doc] << np.uint64(1)) | whole
    by = np.argsort(to, kind="stable")
    word, to = word[by], to[by]
    begin = _starts(to)
    for s, e in zip(begin, [*begin[1:], len(to)]):
        mine = np.sort(word[s:e])
        mine = mine[_starts(mine)]  # copies within the chunk
        planes = np.ascontiguousarray(np.diff(mine, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)
        yield int(to[s]), planes[:6].tobytes(), pa.compress(planes[6:].tobytes(), codec="zstd", asbytes=True)


def unpacked(low: bytes, high: bytes) -> np.ndarray:
    """The words of one chunk and partition, undoing packed()."""
    n = len(low) // 6
    planes = np.empty((8, n), np.uint8)
    planes[:6] = np.frombuffer(low, np.uint8).reshape(6, n)
    planes[6:] = np.frombuffer(pa.decompress(high, 2 * n, codec="zstd"), np.uint8).reshape(2, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def meetings(word: np.ndarray, slice_rows: int = 4_000_000):
    """(tag, tag, how often) of the classes that meet in a partition's words; `word` is sorted in place.

    Slices bound the memory; every pair of a run is made. Two entries of
    neighbourhoods that are no whole content do not meet.
    """
    word.sort()
    fresh = np.ones(len(word), bool)
    fresh[1:] = word[1:] != word[:-1]
    word = word[fresh]
    sig = word >> np.uint64(64 - _SIG_BITS)
    begin = _starts(sig)
    n = np.diff(np.append(begin, len(sig)))
    word = word[np.repeat(n, n) > 1]
    if not len(word):
        return
    sig = word >> np.uint64(64 - _SIG_BITS)
    begin = _starts(sig)
    n = np.diff(np.append(begin, len(sig)))
    # a run's pairs are made row by row: element i with all behind it, in slices over elements
    behind = np.repeat(begin + n, n) - np.arange(len(word)) - 1
    made = np.cumsum(behind)
    cuts = np.unique(np.searchsorted(made, np.arange(0, made[-1], slice_rows), side="right"))
    for s, e in zip(cuts, [*cuts[1:], len(word)]):
        a = np.repeat(np.arange(s, e), behind[s:e])
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(behind[s:e]) - behind[s:e], behind[s:e])
        met = ((word[a] | word[b]) & np.uint64(1)) > 0
        mask = np.uint64((1 << _TAG_BITS) - 1)
        x, y = (word[a[met]] >> np.uint64(1)) & mask, (word[b[met]] >> np.uint64(1)) & mask
        x, y = np.minimum(x, y), np.maximum(x, y)
        other = x != y
        x, y = x[other], y[other]
        by = np.lexsort((y, x))
        x, y = x[by], y[by]
        first = np.ones(len(x), bool)
        first[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(first)
        if len(first):
            yield x[first], y[first], np.diff(np.append(first, len(x)))


def similar(
    df: DataFrame,
    key: str,
    text: str,
    shingle: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
    least_words: int = 0,
    neighbourhoods: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(members, links): each key's class of equal shingle sets, and the pairs of similar classes.

    members (key, set_id) has a row per distinct key and class; links (a, b,
    common, total), a < b, a row per pair of different classes whose Jaccard
    similarity common/total is at least the threshold num/den. Texts of fewer
    than `least_words` words, without a shingle, or null belong to no class.
    Keys delivered again with the same text count once; null keys are left out.
    `neighbourhoods` fixes the index of all bands instead of the estimate.
    """
    num, den = threshold
    if not LEAST_THRESHOLD <= num / den <= 1:
        raise ValueError("the threshold must be between 1/4 and 1")
    spark = df.sparkSession
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull() & F.col("text").isNotNull())
    kind = src.schema["key"].dataType.simpleString()

    def tally(batches):
        seen = np.zeros(SKETCH + BANDS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK, CHUNK_ROWS):
                token, doc = _sets(part.column(1), shingle, least_words)
                seen[:SKETCH] += np.bincount((token % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                seen[SKETCH:] += np.bincount(_band(np.bincount(doc)[np.unique(doc)]), minlength=BANDS)
        return seen

    counts = summed(src, tally, SKETCH + BANDS)
    whole = allocation(counts[:SKETCH], counts[SKETCH:], num, den) if neighbourhoods is None else np.arange(BANDS) * neighbourhoods > 0
    shared = spark.sparkContext.broadcast((steps(counts[:SKETCH]), whole))  # a byte a cell of the sketch
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(int(counts[:SKETCH].sum())))

    def route(batches):
        sketch, allocated = shared.value
        for batch in batches:
            for part in chunks(batch, "text", CHUNK, CHUNK_ROWS):
                token, doc = _sets(part.column(1), shingle, least_words)
                if not len(token):
                    continue
                begin = _starts(doc)
                own = doc[begin]
                set_id = mix(np.add.reduceat(mix(token), begin))
                number = np.full(part.num_rows, -1)
                number[own] = np.arange(len(own))
                made = entries(token, number[doc], sketch, allocated, num, den)
                rows = list(packed(*made, set_id >> np.uint64(64 - _TAG_BITS), n))
                to, low, high = zip(*rows) if rows else ((), (), ())
                keys = part.column(0).take(pa.array(own))
                ids = set_id.view(np.int64)
                none = [None] * len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*to, int(set_id[0]) % n], pa.int32()),
                        pa.array([*low, None], pa.binary()),
                        pa.array([*high, None], pa.binary()),
                        pa.array([*none, ids], pa.list_(pa.int64())),
                        pa.array([*none, keys.to_pylist()], pa.list_(keys.type)),
                    ],
                    names=["p", "low", "high", "ids", "keys"],
                )

    routed = src.mapInArrow(route, f"p int, low binary, high binary, ids array<bigint>, keys array<{kind}>")

    def meet(batches):
        held: dict[int, list] = {}
        key_type = None
        for batch in batches:
            key_type = batch.schema.field("keys").type.value_type
            for row in batch.to_pylist():
                if row["low"] is not None:
                    held.setdefault(row["p"], []).append(unpacked(row["low"], row["high"]))
                    continue
                m = len(row["ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["keys"], key_type), pa.array(row["ids"], pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=["key", "a", "b", "often"]
                )
        for p in list(held):
            for a, b, often in meetings(np.concatenate(held.pop(p))):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(a), key_type), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(often, pa.int64())], names=["key", "a", "b", "often"]
                )

    met = materialise(routed.repartitionById(n, "p").mapInArrow(meet, f"key {kind}, a bigint, b bigint, often bigint"))
    members = met.where("b IS NULL").select("key", F.col("a").alias("set_id")).distinct()
    tags = met.where("b IS NOT NULL").groupBy("a", "b").agg(F.sum("often").alias("often")).where(F.col("often") >= MEETINGS)
    tagged = members.select("set_id", F.shiftrightunsigned("set_id", 64 - _TAG_BITS).alias("tag")).distinct()
    ends = [tagged.select(F.col("set_id").alias(f"s{x}"), F.col("tag").alias(x)) for x in "ab"]
    pairs = tags.join(ends[0], "a").join(ends[1], "b").select(F.least("sa", "sb").alias("a"), F.greatest("sa", "sb").alias("b"))
    links = _verified(src, members, pairs, shingle, least_words, num, den)
    return members.withColumnRenamed("key", key), links


def verified(batch: pa.RecordBatch, shingle: int, least_words: int, num: int, den: int):
    """(a, b, common, total) of the pairs whose texts ta and tb reach the threshold, in chunks of bounded bytes of either text."""
    for part in (p for some in chunks(batch, "ta") for p in chunks(some, "tb")):
        n = part.num_rows
        token, doc = _sets(pa.concat_arrays([part.column("ta"), part.column("tb")]), shingle, least_words)
        size = np.bincount(doc, minlength=2 * n)
        pair = doc % n
        key = (pair.astype(np.uint64) << np.uint64(_TOKEN_BITS)) | token
        key.sort()
        common = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(_TOKEN_BITS)).astype(np.int64), minlength=n)
        total = size[:n] + size[n:] - common
        good = (common * den >= total * num) & (total > 0)
        yield pa.RecordBatch.from_arrays(
            [part.column("a"), part.column("b"), pa.array(common, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "common", "total"]
        ).filter(pa.array(good))


def _verified(src: DataFrame, members: DataFrame, pairs: DataFrame, shingle: int, least_words: int, num: int, den: int) -> DataFrame:
    """The pairs whose sets, taken from one text of each class, reach the threshold."""
    spark = src.sparkSession
    pairs = materialise(pairs)
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    chosen = materialise(members.join(wanted, "set_id").groupBy("set_id").agg(F.min("key").alias("key")))
    marked = spark.sparkContext.broadcast(bitmap(chosen.select(F.xxhash64("key").alias("h"))))  # 16 MB at most

    def pick(batches):
        for b in batches:
            yield b.filter(pa.array(marked.value.has(b.column(2).to_numpy()))).select(["key", "text"])

    texts = src.select("key", "text", F.xxhash64("key").alias("h")).mapInArrow(pick, src.select("key", "text").schema)
    # a key delivered again gives its text again: one per class is enough
    one = texts.join(chosen, "key").groupBy("set_id").agg(F.max("text").alias("text"))
    sides = pairs.join(one.withColumnsRenamed({"set_id": "a", "text": "ta"}), "a").join(one.withColumnsRenamed({"set_id": "b", "text": "tb"}), "b")

    def verify(batches):
        for batch in batches:
            yield from verified(batch, shingle, least_words, num, den)

    links = materialise(sides.select("a", "b", "ta", "tb").mapInArrow(verify, "a bigint, b bigint, common bigint, total bigint"))
    discard(pairs)
    discard(chosen)
    return links


BLOCK = 512  # copies of a class that are paired with each other in one group of rows


def expand(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """All pairs (key_a, key_b), key_a < key_b, of the links and of equal sets.

    Copies of one class are paired block by block, so a class with a third of
    all rows is spread over as many groups as it has pairs of blocks.
    """
    m = members.select(F.col(key).alias("k"), "set_id")
    left, right = m.withColumnsRenamed({"k": "x", "set_id": "a"}), m.withColumnsRenamed({"k": "y", "set_id": "b"})
    across = links.select("a", "b").join(left, "a").join(right, "b").select("x", "y")
    blocks = m.groupBy("set_id").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").select("set_id", "blocks")
    several = m.join(blocks, "set_id").withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    one = several.select("set_id", F.col("k").alias("x"), F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"))
    two = several.select("set_id", F.col("k").alias("y"), F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"))
    within = one.join(two, ["set_id", "i", "j"]).where("i < j OR x < y").select("x", "y")
    return across.union(within).where("x <> y").select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def classes(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """(key, class_id, links): connected groups, named by their smallest key; links counts the linked classes of equal texts, 0 for a text without.

    Minimum labels travel along the links with pointer jumping; every round is
    a written table, and the rounds grow with the logarithm of the longest chain.
    """
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct())
    label = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("l"))
    label = materialise(label)
    rounds = [label]
    while True:
        near = edges.join(label.select(F.col("v").alias("b"), F.col("l").alias("bl")), "b").groupBy("a").agg(F.min("bl").alias("bl"))
        jump = label.select(F.col("v").alias("l"), F.col("l").alias("ll"))
        step = label.join(near.withColumnRenamed("a", "v"), "v").join(jump, "l")
        new = materialise(step.select("v", F.col("l").alias("old"), F.least("l", "bl", "ll").alias("l")))
        rounds.append(new)
        moved = new.where("l <> old").limit(1).count()
        label = new.select("v", "l")
        if not moved:
            break
    for old in rounds[:-1]:
        discard(old)
    degree = edges.groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "v")
    # names are found among classes, a row each, before they meet the members
    sets = members.groupBy("set_id").agg(F.min(key).alias("least")).join(label.join(degree, "v").withColumnRenamed("v", "set_id"), "set_id", "left")
    sets = sets.select("set_id", F.coalesce("l", "set_id").alias("l"), "least", F.coalesce("links", F.lit(0)).alias("links"))
    named = sets.join(sets.groupBy("l").agg(F.min("least").alias("class_id")), "l").select("set_id", "class_id", "links")
    return members.join(named, "set_id").select(key, "class_id", "links")
