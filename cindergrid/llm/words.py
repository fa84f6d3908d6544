"""Folded words of a text as bytes, with the way back to code points of the original.

Folding maps each byte to one byte: A-Z to a-z, every other ASCII byte that is neither a digit nor
a letter to a space. So byte offsets in folded and original text agree.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import SparkSession

_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz")
FOLD = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEEP else 32) for b in range(256))


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this checkout import the package, wherever the driver was started.

    On machines that don't see it, the package must be installed or sent along (``--py-files``).
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def raw_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def folded(raw: bytes | None) -> bytes:
    """The words, each between single spaces: ``b" w1 w2 "``; a single space if there are none."""
    words = (raw or b"").translate(FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def n_words(line: bytes) -> int:
    return line.count(b" ") - 1


class Original:
    """Maps offsets in a folded line to code points of the original text."""

    def __init__(self, raw: bytes, line: bytes):
        marks = np.frombuffer(b" " + raw.translate(FOLD) + b" ", np.uint8) == 32
        self.raw = raw
        self.points: np.ndarray | None = None
        self.word_starts = np.flatnonzero(marks[:-1] & ~marks[1:])
        self.spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)

    def word_at(self, offset: int) -> int:
        """The word that holds this offset of the line; a space belongs to the word behind it."""
        return int(np.searchsorted(self.spaces, offset, side="right")) - 1

    def code_point(self, offset: int) -> int:
        """Of a non-space offset in the line."""
        word = self.word_at(offset)
        at = int(self.word_starts[word]) + offset - int(self.spaces[word]) - 1
        if self.points is None:  # code points that begin before each byte, counted once for all places asked about
            begins = np.frombuffer(self.raw, np.uint8) & 0xC0 != 0x80
            self.points = np.concatenate([[0], np.cumsum(begins)])
        return int(self.points[at])


def with_columns(batch: pa.RecordBatch, columns: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text, one row at least."""
    sizes = np.array([0 if r is None else r for r in pa.compute.binary_length(batch.column(text)).to_pylist()], np.int64)
    part = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
