"""Share of repeated content within each document.

Method: log-likelihood ratio between two multinomials over hashed n-grams. A
document is the sequence of its n-grams; an n-gram that occurred earlier in
the document is the feature `again, bucket of its hash`, all others are the one
feature `new`. The raw corpus counts the features of all documents; the
trusted target counts the n-grams of the documents named as trusted as they
would stand without repetition, every n-gram once and so as `new`. Both are
smoothed by a total of one count. A document's score is the sum of log
p(target)/p(raw) over its n-grams, divided by their number. Every document is
held against one threshold, which follows from the two tables: no document
with the share `least` of its words in repeated passages can score above it.
The exact share of words, measured in the same pass over the texts that
collects the features, stands beside the score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.words import Words, chunks, words
from tabularium.session import materialise

PASSAGE = 8
LEAST = 0.3
BUCKETS = 1 << 20  # bounds what is collected and broadcast: one count a bucket


def _repeats(w: Words, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which n-grams occurred earlier in the same text."""
    order = np.lexsort((at, grams, w.doc[at]))
    g, d = grams[order], w.doc[at][order]
    again = np.zeros(len(at), bool)
    again[order[1:]] = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
    return again


class Ratios:
    """log p(target)/p(raw) of every feature, and the threshold that follows."""

    def __init__(self, again: np.ndarray, grams: int, trusted: int, least: float, passage: int):
        """`again` counts the corpus' repeated n-grams by bucket, `grams` all n-grams, `trusted` the target's."""
        a = 1.0 / (len(again) + 1)  # smoothing: one count spread over all features
        raw = math.log(grams + 1)
        target = math.log(trusted + 1)
        self.new = (math.log(trusted + a) - target) - (math.log(grams - int(again.sum()) + a) - raw)
        self.again = (math.log(a) - target) - (np.log(again + a) - raw)
        # a repeated n-gram covers at most `passage` words, so at least this share of the n-grams is repeated; a repeated
        # n-gram's ratio is at most that of a bucket with one count, and the score is linear in the share
        share, most = least / passage, (math.log(a) - target) - (math.log(1 + a) - raw)
        self.threshold = max(share * most + (1 - share) * self.new, most) + 1e-9


def features(df: DataFrame, key: str, text: str, trusted: Column, passage: int, buckets: int) -> DataFrame:
    """(key, n_words, repeated_words, grams, fresh, trusted, bucket, times): one pass over the texts.

    fresh is the number of different n-grams; bucket and times are arrays that
    hold the repeated n-grams only.
    """
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(trusted, F.lit(False)).alias("trusted"))
    key_type = src.schema["key"].dataType.simpleString()

    def measure(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                w = words(part.column(1))
                n = part.num_rows
                g, at = w.grams(passage)
                doc = w.doc[at]
                again = _repeats(w, g, at)
                start = at[again]
                edges = np.bincount(start, minlength=len(w.hash) + 1) - np.bincount(start + passage, minlength=len(w.hash) + 1)
                covered = np.bincount(w.doc[np.cumsum(edges[:-1]) > 0], minlength=n)
                pairs, times = np.unique(doc[again].astype(np.int64) * buckets + (g[again] % np.uint64(buckets)).astype(np.int64), return_counts=True)
                offsets = pa.array(np.searchsorted(pairs, np.arange(n + 1) * buckets), pa.int32())
                grams = np.bincount(doc, minlength=n)
                yield pa.record_batch(
                    {
                        "key": part.column(0),
                        "n_words": pa.array(np.diff(w.first), pa.int64()),
                        "repeated_words": pa.array(covered, pa.int64()),
                        "grams": pa.array(grams, pa.int64()),
                        "fresh": pa.array(grams - np.bincount(doc[again], minlength=n), pa.int64()),
                        "trusted": part.column(2),
                        "bucket": pa.ListArray.from_arrays(offsets, pa.array(pairs % buckets, pa.int32())),
                        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                    }
                )

    return src.mapInArrow(
        measure,
        f"key {key_type}, n_words bigint, repeated_words bigint, grams bigint, fresh bigint, trusted boolean, bucket array<int>, times array<int>",
    )


def repetition(df: DataFrame, key: str, text: str, trusted: Column, least: float = LEAST, passage: int = PASSAGE, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_words, repeated_words, repeated_share, score, repetitive) of every row.

    repeated_words are the words lying in passages of `passage` words or more
    that occurred earlier in the same text; an earlier occurrence may overlap.
    `trusted` says which rows are the trusted target (null is no); without any
    nothing can be told apart and every document reaches the threshold.
    repetitive is whether the score reaches it. A null or empty text has no
    words, share 0.0 and score 0.0. Keys may repeat or be null: one result row
    per input row. Other columns are ignored.
    """
    rows = materialise(features(df, key, text, trusted, passage, buckets))
    total = rows.agg(F.coalesce(F.sum("grams"), F.lit(0)).alias("g"), F.coalesce(F.sum(F.when(F.col("trusted"), F.col("fresh"))), F.lit(0)).alias("t")).first()
    pairs = rows.select(F.inline(F.arrays_zip("bucket", "times"))).groupBy("bucket").agg(F.sum("times").alias("n")).toArrow()
    again = np.zeros(buckets, np.int64)
    again[pairs.column("bucket").to_numpy()] = pairs.column("n").to_numpy()
    ratios = Ratios(again, total["g"], total["t"], least, passage)
    table = df.sparkSession.sparkContext.broadcast((ratios.again.astype(np.float32), ratios.new, ratios.threshold))

    def score(batches):
        again, new, threshold = table.value
        for b in batches:
            grams, fresh = b.column(3).to_numpy(), b.column(4).to_numpy()
            owner = np.repeat(np.arange(b.num_rows), np.diff(b.column(5).offsets.to_numpy()))
            said = np.bincount(owner, again[b.column(5).flatten().to_numpy()] * b.column(6).flatten().to_numpy(), minlength=b.num_rows)
            mean = (said + new * fresh) / np.maximum(grams, 1)
            n, covered = b.column(1).to_numpy(), b.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(covered / np.maximum(n, 1), pa.float64()), pa.array(mean, pa.float64()), pa.array((mean <= threshold) & (grams > 0))],
                names=["key", "n_words", "repeated_words", "repeated_share", "score", "repetitive"],
            )

    out = rows.select("key", "n_words", "repeated_words", "grams", "fresh", "bucket", "times").mapInArrow(
        score, f"key {rows.schema['key'].dataType.simpleString()}, n_words bigint, repeated_words bigint, repeated_share double, score double, repetitive boolean"
    )
    return out.withColumnRenamed("key", key)
