"""Sets of hashes as sparse bitmaps small enough to be sent to every task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS = 27  # 2^27 bits, 16 MB if all slices are there: the bound of what is collected and broadcast
_SLICE = 12  # 2^12 bits travel as one row


@dataclass
class Bitmap:
    """Bits by hash; slices without a bit are one row of zeros."""

    row_of: np.ndarray  # of every slice
    rows: np.ndarray  # uint8[rows, bytes of a slice]

    @property
    def empty(self) -> bool:
        return len(self.rows) == 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be in the set: always for those that are, seldom for others unless the set is very large."""
        slot = hashes.astype(np.int64, copy=False) & ((1 << BITS) - 1)
        at = slot & ((1 << _SLICE) - 1)
        return (self.rows[self.row_of[slot >> _SLICE], at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bitmap(hashes: DataFrame) -> Bitmap:
    """The bitmap of the one bigint column; one job, nulls are left out.

    A set of more than some tens of millions fills the bitmap: then more of
    what is tested passes, and nothing is lost.
    """
    c = hashes.columns[0]
    slot = hashes.where(f"{c} IS NOT NULL").selectExpr(f"cast((({c} & {(1 << BITS) - 1}L) >> {_SLICE}) AS int) AS slice", f"cast({c} & {(1 << _SLICE) - 1}L AS int) AS at")

    def pack(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            which, at = b.column(0).to_numpy(), b.column(1).to_numpy()
            by = np.argsort(which, kind="stable")
            which, at = which[by], at[by]
            edges = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else []
            for s, e in zip(edges, [*edges[1:], len(which)]):
                held.setdefault(int(which[s]), np.zeros(1 << _SLICE, bool))[at[s:e]] = True
        yield pa.record_batch({"slice": pa.array(list(held), pa.int32()), "bits": pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())})

    found = slot.distinct().repartition("slice").mapInArrow(pack, "slice int, bits binary").toArrow()
    row_of = np.zeros(1 << (BITS - _SLICE), np.int32)
    row_of[found.column("slice").to_numpy()] = np.arange(1, found.num_rows + 1)
    rows = np.zeros((found.num_rows + 1, (1 << _SLICE) // 8), np.uint8)
    for i, b in enumerate(found.column("bits").to_pylist(), 1):
        rows[i] = np.frombuffer(b, np.uint8)
    return Bitmap(row_of, rows)
