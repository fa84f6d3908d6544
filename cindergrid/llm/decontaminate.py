"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all test items.

Items are folded to words (A-Z lowered; everything but ASCII digits, letters and non-ASCII is a gap)
and cut into windows of ``window`` words; a shorter item is one window. Each text is folded once and
scanned once. Spans come back as word numbers and as code points of the original text.

The windows are counted before they are collected: beyond ``MAX_WINDOWS`` they are split into parts
by hash, one automaton and one scan per part, with what was found so far stored between scans. So the
broadcast stays bounded however large the benchmark is.

Defined results: a NULL or empty text or item has no words; an item whose id is NULL marks words but is
not listed; repeated items count once; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindergrid.llm.words import Original, folded, importable, n_words, raw_bytes, with_columns
from cindergrid.session import work_folder

WINDOW = 10
#: Windows in one automaton; at ten words of common length some 20 MB.
MAX_WINDOWS = 200_000

SPAN = T.StructType(
    [T.StructField(n, T.LongType(), False) for n in ("first_word", "last_word", "start", "end")]
)
_ARROW_SPAN = pa.struct([pa.field(n, pa.int64(), False) for n in ("first_word", "last_word", "start", "end")])
FOUND = {"__n_words": T.LongType(), "__spans": T.ArrayType(SPAN), "__items": T.ArrayType(T.StringType())}

_automata: dict[int, tuple] = {}


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (``window`` folded words, ``item``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), strict=True):
                words = folded(raw).split()
                starts = range(max(1, len(words) - window + 1)) if words else range(0)
                for a in range(0, len(starts), 4096):
                    lines = [b" " + b" ".join(words[i : i + window]) + b" " for i in starts[a : a + 4096]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lines, pa.binary()), pa.array([item] * len(lines), pa.string())], names=["window", "item"]
                    )

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "window binary, item string").distinct()


def _automaton(key: int, pairs) -> tuple:
    """Built once per worker: the automaton, and per window its number of words and its items."""
    if key not in _automata:
        import ahocorasick

        of: dict[bytes, list] = {}
        for window, item in pairs.value:
            of.setdefault(bytes(window), []).append(item)
        machine, known = ahocorasick.Automaton(), []
        for window, named in of.items():
            machine.add_word(window.decode("latin-1"), len(known))
            known.append((n_words(window), [x for x in named if x is not None]))
        machine.make_automaton()
        _automata.clear()
        _automata[key] = (machine, known)
    return _automata[key]


def _hits(line: bytes, machine, known: list) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged (first, last) words of all occurrences, and the items they belong to."""
    ends, items = [], set()
    for end, k in machine.iter(line.decode("latin-1")):
        ends.append((end, k))
    if not ends:
        return [], items
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(spaces, [e for e, _ in ends]) - 1
    merged: list[tuple[int, int]] = []
    for k in {k for _, k in ends}:
        items.update(known[k][1])
    for a, b in sorted((int(z) - known[k][0] + 1, int(z)) for z, (_, k) in zip(last, ends, strict=True)):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged, items


def _scan(docs: DataFrame, text: str, pairs, key: int, again: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = _automaton(key, pairs)
        for batch in batches:
            old_spans = batch.column("__spans").to_pylist() if again else None
            old_items = batch.column("__items").to_pylist() if again else None
            counts, spans, items = [], [], []
            for i, raw in enumerate(raw_bytes(batch.column(text))):
                line = folded(raw)
                merged, found = _hits(line, machine, known) if known else ([], set())
                if again:
                    found |= set(old_items[i])
                    merged = _union(merged, [(s["first_word"], s["last_word"]) for s in old_spans[i]])
                counts.append(n_words(line) if len(line) > 1 else 0)
                items.append(sorted(found))
                spans.append(_placed(raw, line, merged))
            if again:
                batch = batch.drop_columns(list(FOUND))
            yield with_columns(
                batch,
                [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_ARROW_SPAN)), pa.array(items, pa.list_(pa.string()))],
                list(FOUND),
            )

    before = [f for f in docs.schema.fields if f.name not in FOUND]
    schema = T.StructType([*before, *[T.StructField(n, t) for n, t in FOUND.items()]])
    return docs.mapInArrow(run, schema)


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for x, y in sorted([*a, *b]):
        if merged and x <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(y, merged[-1][1]))
        else:
            merged.append((x, y))
    return merged


def _placed(raw: bytes | None, line: bytes, merged: list[tuple[int, int]]) -> list[dict]:
    if not merged:
        return []
    at = Original(raw, line)
    return [
        {
            "first_word": a,
            "last_word": b,
            "start": at.code_point(int(at.spaces[a]) + 1),
            "end": at.code_point(int(at.spaces[b + 1]) - 1) + 1,
        }
        for a, b in merged
    ]


def scan(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` with ``__n_words``, ``__spans`` (merged runs of hit words) and ``__items`` (sorted)."""
    spark = docs.sparkSession
    importable(spark)
    path = work_folder(spark, "benchmark-windows")
    benchmark_windows(items, item_id, item_text, window).write.parquet(path)
    windows = spark.read.parquet(path)
    parts = max(1, -(-windows.count() // max_windows))
    out = docs
    for part in range(parts):
        if part:
            stored = work_folder(spark, "benchmark-scan")
            out.write.parquet(stored)
            out = spark.read.parquet(stored)
        mine = windows.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        pairs = spark.sparkContext.broadcast([tuple(r) for r in mine.collect()])
        out = _scan(out, text, pairs, pairs._jbroadcast.id(), bool(part))
    return out
