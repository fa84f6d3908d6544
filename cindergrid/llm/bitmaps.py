"""A set of 64-bit keys as a bitmap of fixed size, small enough to send to every executor.

A key's slot is taken from its hash, so the bitmap holds every key of the set and, rarely, others: it says which rows
can be left out, never which belong. However many keys there are, it is ``1 << bits`` bits and no more; a full one
leaves nothing out and changes no result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB.
BITS = 26


def slots(keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def key_of(column: Column | str) -> Column:
    """A 64-bit key of any column, NULL included."""
    return F.xxhash64(column)


def marked(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap (bytes) of the one column of ``keys``, built in parts of 512 bits by Spark."""

    def run(batches):
        import pyarrow as pa

        seen = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            _set(seen, slots(np.asarray(batch.column(0)), bits))
        part = np.flatnonzero(seen.reshape(-1, 64).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([p.tobytes() for p in seen.reshape(-1, 64)[part]], pa.binary())], names=["part", "found"])

    def both(rows):
        import pyarrow as pa

        one = np.bitwise_or.reduce([np.frombuffer(p, np.uint8) for p in rows["found"].to_pylist()])
        return pa.table([rows["part"][:1], pa.array([one.tobytes()], pa.binary())], names=["part", "found"])

    kind = "part long, found binary"
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in keys.mapInArrow(run, kind).groupBy("part").applyInArrow(both, kind).toLocalIterator():
        out[row["part"] * 64 : row["part"] * 64 + 64] = np.frombuffer(row["found"], np.uint8)
    return out


def _set(seen: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(seen, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def holds(bitmap: np.ndarray, keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    at = slots(keys, bits)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
