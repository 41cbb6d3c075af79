"""Passages of held-out test items inside corpus documents.

Method: greedy string tiling. Running Karp-Rabin hashes of `seed` words are
joined between items and documents; seeds on one diagonal merge into maximal
matches; of these the longest is marked again and again, each marked word
counting once, until no unmarked match of `seed` words is left. The tiles'
share of the item is its coverage, which also catches passages in another
order; the longest match gives verbatim leaks.

The items' seeds are sent to every task if there are few enough; a document
then meets all items in its own task and nothing is shuffled, however common a
seed is. Beyond that size, the documents' hashes pass a bitmap of the items'
hashes and are joined by seed, and the hits of a pair stream into the tiler in
order. Either way gives the same rows. Pairs whose hits could not reach a
leak, were all of them tiles, are not tiled.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.words import Words, chunks, words
from tabularium.sources.bitmaps import bitmap

SEED = 5
VERBATIM = 15
COVERAGE = 0.5
SENT_SEEDS = 2_000_000  # of the items; up to here (about 32 MB) they are broadcast
HITS = 4_000_000  # looked at at once


def _item_seeds(w: Words, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the items' seeds; an item of fewer words is one seed of its own length."""
    size = np.diff(w.first)
    hashes, places = [], []
    for n in sorted({int(min(k, seed)) for k in size if k}):
        g, at = w.grams(n)
        own = np.minimum(size, seed)[w.doc[at]] == n
        hashes.append(_of_length(g[own], n))
        places.append(at[own])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def _of_length(g: np.ndarray, n: int) -> np.ndarray:
    return g ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))


def tiles(i: np.ndarray, j: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of the hits (document position, item position): (start in document, start in item, words)."""
    diagonal = i - j
    order = np.lexsort((i, diagonal))
    i, j, diagonal = i[order], j[order], diagonal[order]
    fresh = np.ones(len(i), bool)
    fresh[1:] = (diagonal[1:] != diagonal[:-1]) | (i[1:] - i[:-1] > 1)
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(i)) - 1
    heap = [(-(int(i[e]) - int(i[b]) + seed), int(i[b]), int(j[b])) for b, e in zip(begin, end)]
    heapq.heapify(heap)
    marked_i: set[int] = set()
    marked_j: set[int] = set()
    found = []
    while heap:
        length, a, b = heapq.heappop(heap)
        length = -length
        free = [k for k in range(length) if a + k not in marked_i and b + k not in marked_j]
        if len(free) == length:
            found.append((a, b, length))
            marked_i.update(range(a, a + length))
            marked_j.update(range(b, b + length))
            continue
        start = 0
        for k in range(1, len(free) + 1):  # what is left of a match that was partly marked
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= seed:
                    heapq.heappush(heap, (-(k - start), a + free[start], b + free[start]))
                start = k
    return found


class Seeds:
    """The items' seeds, sorted by hash."""

    def __init__(self, table: pa.Table):
        """From rows (item, seed, j, n) of all items."""
        ids = table.column("item").combine_chunks()
        ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
        coded = ids.dictionary_encode(null_encoding="encode")
        self.ids = coded.dictionary
        item = np.asarray(coded.indices).astype(np.int32)
        h = table.column("seed").to_numpy().view(np.uint64)
        by = np.argsort(h, kind="stable")
        self.item, self.j = item[by], table.column("j").to_numpy()[by].astype(np.int32)
        self.hash, self.first = np.unique(h[by], return_index=True)
        self.first = np.append(self.first, len(h))
        n = table.column("n").to_numpy()
        self.words = np.zeros(len(self.ids), np.int64)
        self.words[item] = n
        self.sizes = sorted({int(x) for x in np.unique(table.column("k").to_numpy())})
        self.mask = np.uint64((1 << max(16, (16 * len(self.hash)).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(self.hash & self.mask).astype(np.int64)] = True

    def look_up(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into g, index of the seed) of the hashes that occur."""
        at = np.flatnonzero(self.bits[(g & self.mask).astype(np.int64)])
        if not len(at) or not len(self.hash):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k = np.minimum(np.searchsorted(self.hash, g[at]), len(self.hash) - 1)
        good = self.hash[k] == g[at]
        return at[good], k[good]


def _expanded(seeds: Seeds, doc: np.ndarray, i: np.ndarray, k: np.ndarray):
    """Slices of hits (doc, item, i, j), every (doc, item) whole in one slice; doc ascends."""
    times = seeds.first[k + 1] - seeds.first[k]
    upto = np.cumsum(times)
    begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.empty(0, np.int64)
    ends = np.append(begin[1:], len(doc))
    s = 0
    while s < len(begin):
        base = upto[begin[s]] - times[begin[s]]
        e = s + 1
        while e < len(begin) and upto[ends[e] - 1] - base <= HITS:
            e += 1
        lo, hi = begin[s], ends[e - 1]
        total = int(upto[hi - 1] - base)
        parts = [(0, len(seeds.ids))]
        if total > HITS:  # one long document full of common seeds: item by item, as many at a time as fit
            per = np.zeros(len(seeds.ids), np.int64)
            for a in range(lo, hi, 65_536):
                b = min(hi, a + 65_536)
                own = np.repeat(seeds.first[k[a:b]], times[a:b]) + np.arange(int(times[a:b].sum())) - np.repeat(np.cumsum(times[a:b]) - times[a:b], times[a:b])
                per += np.bincount(seeds.item[own], minlength=len(per))
            cuts = [0]
            held = 0
            for x, c in enumerate(per):
                if held and held + c > HITS:
                    cuts.append(x)
                    held = 0
                held += c
            parts = list(zip(cuts, [*cuts[1:], len(per)]))
        for first, last in parts:
            rows = []
            for a in range(lo, hi, 65_536):
                b = min(hi, a + 65_536)
                t = times[a:b]
                own = np.repeat(seeds.first[k[a:b]], t) + np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
                item = seeds.item[own]
                keep = (item >= first) & (item < last)
                rows.append((np.repeat(doc[a:b], t)[keep], item[keep], np.repeat(i[a:b], t)[keep], seeds.j[own][keep]))
            yield tuple(np.concatenate(x) for x in zip(*rows))
        s = e


def _tiled(doc: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, n_words: np.ndarray, seed: int, verbatim: int, coverage: float):
    """(doc, item, item words, longest, covered) of the pairs that leak; n_words is per item."""
    by = np.lexsort((j, item, doc))
    doc, item, i, j = doc[by], item[by], i[by], j[by]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(doc))
    n = n_words[item]
    length = np.minimum(seed, n)
    # the words of the item that any hit covers: what tiles could reach at most
    step = np.append(j[1:], 0) - j
    step[end - 1] = seed
    most = np.add.reduceat(np.minimum(step, length), begin)
    size = n[begin]
    out = []
    for p in np.flatnonzero(most >= np.minimum(np.minimum(verbatim, size), coverage * size)):
        a, b = begin[p], end[p]
        t = tiles(i[a:b].astype(np.int64), j[a:b].astype(np.int64), int(length[a]))
        longest, total, words_ = max(x[2] for x in t), sum(x[2] for x in t), int(size[p])
        if longest >= min(verbatim, words_) or total >= coverage * words_:
            out.append((int(doc[a]), int(item[a]), words_, longest, total))
    return out


def _result(docs: pa.Array, items: pa.Array, rows: list, verbatim: int) -> pa.RecordBatch:
    d, i, n, longest, covered = (np.array(x) for x in zip(*rows)) if rows else (np.empty(0, np.int64),) * 5
    return pa.RecordBatch.from_arrays(
        [
            items.take(pa.array(i, pa.int64())),
            docs.take(pa.array(d, pa.int64())),
            pa.array(n, pa.int32()),
            pa.array(longest, pa.int32()),
            pa.array(covered, pa.int32()),
            pa.array(covered / np.maximum(n, 1), pa.float64()),
            pa.array(longest >= np.minimum(verbatim, n), pa.bool_()),
        ],
        names=["item", "doc", "item_words", "longest", "covered", "coverage", "verbatim"],
    )


def _hashes(w: Words, sizes: list[int]):
    """(text, position in the text, hash) of a batch's seeds of the given lengths, in order of the texts."""
    parts = []
    for n in sizes:
        g, at = w.grams(n)
        parts.append((w.doc[at], at - w.first[w.doc[at]], _of_length(g, n)))
    if len(parts) == 1:
        return parts[0]
    doc, i, g = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
    by = np.argsort(doc, kind="stable")
    return doc[by], i[by], g[by]


def leaks(
    docs: DataFrame,
    doc_id: str,
    doc_text: str,
    items: DataFrame,
    item_id: str,
    item_text: str,
    seed: int = SEED,
    verbatim: int = VERBATIM,
    coverage: float = COVERAGE,
    sent_seeds: int = SENT_SEEDS,
) -> DataFrame:
    """(item_id, doc_id, item_words, longest, covered, coverage, verbatim) of every leak.

    A pair is a leak if the document holds `verbatim` consecutive words of the
    item (all its words if it has fewer), or if the tiles of `seed` words or
    more cover the share `coverage` of it. Texts without words leak nothing.
    Rows repeated under one id count as one text delivered again; different
    texts under one id are looked at apart; null ids are one id. Result columns
    are named as in the inputs.
    """
    source = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).distinct()
    it = source.schema["item"].dataType.simpleString()
    dt = docs.schema[doc_id].dataType.simpleString()
    spark = docs.sparkSession

    def item_rows(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                w = words(part.column(1))
                g, at = _item_seeds(w, seed)
                size = np.diff(w.first)
                n = size[w.doc[at]]
                yield pa.record_batch(
                    {
                        "item": part.column(0).take(pa.array(w.doc[at])),
                        "seed": pa.array(g.view(np.int64)),
                        "j": pa.array(at - w.first[w.doc[at]], pa.int32()),
                        "n": pa.array(n, pa.int32()),
                        "k": pa.array(np.minimum(n, seed), pa.int32()),
                    }
                )

    seeds = source.mapInArrow(item_rows, f"item {it}, seed bigint, j int, n int, k int")
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text"))
    schema = f"item {it}, doc {dt}, item_words int, longest int, covered int, coverage double, verbatim boolean"
    few = seeds.limit(sent_seeds + 1).toArrow()
    if few.num_rows <= sent_seeds:
        sent = spark.sparkContext.broadcast(few)

        def meet(batches):
            s = Seeds(sent.value)
            for batch in batches:
                for part in chunks(batch, "text"):
                    doc, i, g = _hashes(words(part.column(1)), s.sizes)
                    at, k = s.look_up(g)
                    rows = [r for hits in _expanded(s, doc[at], i[at], k) for r in _tiled(*hits, s.words, seed, verbatim, coverage)]
                    yield _result(part.column(0), s.ids, rows, verbatim)

        found = texts.mapInArrow(meet, schema)
    else:
        found = _by_join(spark, texts, seeds, it, dt, schema, seed, verbatim, coverage)
    return found.distinct().withColumnsRenamed({"item": item_id, "doc": doc_id})


def _by_join(spark, texts: DataFrame, seeds: DataFrame, it: str, dt: str, schema: str, seed: int, verbatim: int, coverage: float) -> DataFrame:
    """The leaks where the items are too many to be sent: an equi-join on the seeds, then one stream of hits per pair."""
    sizes = sorted(r["k"] for r in seeds.select("k").distinct().collect())  # at most `seed` numbers
    shared = spark.sparkContext.broadcast(bitmap(seeds.select("seed")))  # 16 MB at most

    def doc_rows(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                doc, i, g = _hashes(words(part.column(1)), sizes)
                hit = shared.value.has(g.view(np.int64))
                at = pa.array(doc[hit])
                yield pa.record_batch(
                    {"doc": part.column(0).take(at), "copy": part.column(2).take(at), "seed": pa.array(g[hit].view(np.int64)), "i": pa.array(i[hit], pa.int32())}
                )

    grams = texts.withColumn("copy", F.xxhash64("text")).mapInArrow(doc_rows, f"doc {dt}, copy bigint, seed bigint, i int")
    hits = grams.join(seeds, "seed").select("doc", "copy", "item", "n", "i", "j").repartition("doc", "copy", "item").sortWithinPartitions("doc", "copy", "item")

    def tile_rows(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks()
            # the last pair may go on in the next batch
            keys = [whole.column(c).to_pylist() for c in ("doc", "copy", "item")] if whole.num_rows < 4096 else None
            last = whole.num_rows
            key = tuple(whole.column(c)[-1].as_py() for c in ("doc", "copy", "item"))
            while last > 0 and (tuple(k[last - 1] for k in keys) if keys else tuple(whole.column(c)[last - 1].as_py() for c in ("doc", "copy", "item"))) == key:
                last -= 1
            if last:
                yield from _pairs(whole.slice(0, last))
            held = whole.slice(last).to_batches()
        if held:
            yield from _pairs(pa.Table.from_batches(held))

    def _pairs(table: pa.Table):
        codes = [np.asarray(table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices).astype(np.int64) for c in ("doc", "copy", "item")]
        pair = np.cumsum(np.append(False, np.any([c[1:] != c[:-1] for c in codes], axis=0))) if table.num_rows else np.empty(0, np.int64)
        first = np.unique(pair, return_index=True)[1]
        n = table.column("n").to_numpy()
        rows = _tiled(pair, pair, table.column("i").to_numpy(), table.column("j").to_numpy(), n[first].astype(np.int64), seed, verbatim, coverage)
        at = first[[r[0] for r in rows]] if rows else np.empty(0, np.int64)
        one = [(a, a, *r[2:]) for a, r in zip(at.tolist(), rows)]
        yield _result(table.column("doc").combine_chunks(), table.column("item").combine_chunks(), one, verbatim)

    return hits.mapInArrow(tile_rows, schema)
