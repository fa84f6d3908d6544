"""Blocks of hashes with their documents, as rows that Spark shuffles by bucket.

A block's arrays are stored as byte planes, which compress well where sorted values share their high bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = "bucket long, kind int, keys binary, extras binary, owners binary, docs binary"
_SCHEMA = pa.schema(
    [("bucket", pa.int64()), ("kind", pa.int32()), *[(n, pa.binary()) for n in ("keys", "extras", "owners", "docs")]]
)


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unplaned(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def packed(kind: int, to: np.ndarray, key: np.ndarray, extra: np.ndarray, doc: np.ndarray) -> Iterator[tuple]:
    """One row per bucket of ``to``; a block names its documents once."""
    if not len(to):
        return
    order = np.lexsort((key, to))
    to, key, extra, doc = to[order], key[order], extra[order], doc[order]
    edges = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        docs, owner = np.unique(doc[a:b], return_inverse=True)
        more = planes(extra[a:b]) if extra[a:b].any() else b""
        yield int(to[a]), kind, planes(key[a:b]), more, planes(owner.astype(np.uint32)), planes(docs)


def rows_of(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_SCHEMA)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def unpacked(block: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind: keys, extras and documents of all rows of a block, side by side."""
    kinds = block["kind"].to_pylist()
    for kind in sorted(set(kinds)):
        key, extra, doc = [], [], []
        for i in (i for i, k in enumerate(kinds) if k == kind):
            key.append(unplaned(block["keys"][i].as_py(), np.uint64))
            more = block["extras"][i].as_py()
            extra.append(unplaned(more, np.uint64) if more else np.zeros(len(key[-1]), np.uint64))
            doc.append(unplaned(block["docs"][i].as_py(), np.int64)[unplaned(block["owners"][i].as_py(), np.uint32)])
        yield kind, np.concatenate(key), np.concatenate(extra), np.concatenate(doc)

