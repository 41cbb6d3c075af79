"""Sums of fixed-length count vectors over all tasks, shuffled as packed and compressed slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICES = 32
_SCHEMA = "slice int, counts binary"


def summed(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int) -> np.ndarray:
    """`count` reduces one task's batches to int64[length]; the result is the sum over all tasks.

    Every task emits SLICES packed rows, so the shuffle is at most tasks x 8 x
    length bytes (about one byte a small count, once compressed) and what
    reaches the driver is 8 x length bytes, whatever the rows. `length` must
    be a multiple of SLICES.
    """
    step = length // SLICES

    def rows_of(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
        held = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in slices.values()]
        return pa.record_batch({"slice": pa.array(list(slices), pa.int32()), "counts": pa.array(held, pa.binary())})

    def opened(b: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(b, 8 * step, codec="zstd"), np.int64)

    def partial(batches):
        v = count(batches).astype(np.int64)
        yield rows_of({i: v[i * step : (i + 1) * step] for i in range(SLICES)})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = opened(v)
                sums[s] = sums[s] + x if s in sums else x
        yield rows_of(sums)

    rows = df.mapInArrow(partial, _SCHEMA).repartition(SLICES, "slice").mapInArrow(add, _SCHEMA).collect()
    out = np.zeros(length, np.int64)
    for r in rows:
        out[r["slice"] * step : (r["slice"] + 1) * step] += opened(r["counts"])
    return out

