"""Ranked lexical search over bit-sliced Bloom signatures.

1. ``build``: every document with a term gets a signature with one entry per distinct term, and one more for
   each of ``LEVELS`` that its number of occurrences reaches. Documents of like width share a block, which
   is stored by slices: slice i has bit i of all its documents, a bitmap with a document per column.
2. ``search``: the documents that hold a query term are counted over the texts, which gives its weight.
3. The slices of a term's hashes, ANDed, are a bitmap of the documents that may have it, and level by level
   of those that may have it so often. It overestimates and never misses, so the weighted sum of these
   bitmaps over an item's terms is an upper bound of each document's score.
4. The documents with the highest bounds are scored from their texts; an item's 20th best of these is its
   threshold. Then every document whose bound reaches a threshold is scored, all others are provably out.

Items are taken in parts of bounded size, and each part is searched in all documents, so what is sent to the
executors is bounded: a part's terms and a bitmap of 8 MB of the documents to score.

Defined results: a NULL or empty text has no term, is no document for the weights and is never found; an item
without terms finds nothing; repeated documents are ranked one by one, repeated items searched one by one; a NULL
doc_id stands behind all others among equal scores; without documents or items there are no rows.
Other columns are not read, whatever their names. A text is one row of a task, as long as it may be.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cindergrid.llm.bitmaps import holds, key_of, marked
from cindergrid.llm.scratch import Scratch
from cindergrid.llm.shingles import mixed
from cindergrid.llm.words import FOLD, importable, raw_bytes

#: Occurrences from which a term has a further entry in the signature.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 32)
#: Bits of a signature per entry (up to twice as many, widths are powers of two) and hashes of an entry.
ENTRY_BITS, HASHES = 8, 4
#: Bits of a block.
BLOCK_BITS = 1 << 22
#: Items and distinct terms of a part; an item with more terms is a part of its own.
PART_ITEMS, PART_TERMS = 256, 8192
#: Documents of the highest bounds that set an item's threshold, per document returned.
SEEDS = 2

INDEX = "width int, ids array<long>, lengths binary, slices binary"


def terms(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


def part_of_score(tf, m):
    """What a term of weight 1 adds to the score, by its occurrences and the document's length figure."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_figure(n, n_docs: int, n_terms: int):
    return 75 + (25 * n * n_docs) // n_terms


def _entries(hashes: np.ndarray, level: int) -> np.ndarray:
    return mixed(hashes + np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1)))


def _bits(entries: np.ndarray, width: int) -> np.ndarray:
    """(entries, hashes): the bits of each entry in a signature of ``width`` bits."""
    step = (entries >> np.uint64(32)) | np.uint64(1)
    return ((entries[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(width - 1)).astype(np.int64)


def build(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: blocks of documents of one signature width, as slices."""
    importable(docs.sparkSession)

    def block(width: int, rows: list[tuple]) -> pa.RecordBatch:
        ids, lengths, bits = zip(*rows, strict=True)
        grid = np.zeros((width, len(ids)), np.uint8)
        grid[np.concatenate(bits), np.repeat(np.arange(len(ids)), [len(b) for b in bits])] = 1
        columns = [[width], [list(ids)], [np.array(lengths, np.int64).tobytes()], [np.packbits(grid, axis=1).tobytes()]]
        kinds = [pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["width", "ids", "lengths", "slices"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list[tuple]] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), strict=True):
                words = terms(raw)
                if not words:
                    continue
                count = Counter(words)
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, count), np.uint64, len(count))
                tf = np.fromiter(count.values(), np.int64, len(count))
                entries = np.concatenate([_entries(hashes[tf >= least], level) for level, least in enumerate(LEVELS)])
                width = 1 << max(6, (ENTRY_BITS * len(entries) - 1).bit_length())
                rows = open_.setdefault(width, [])
                rows.append((i, len(words), np.unique(_bits(entries, width))))
                if len(rows) * width >= BLOCK_BITS:
                    yield block(width, open_.pop(width))
        for width, rows in open_.items():
            yield block(width, rows)

    docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, INDEX).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


class _Part:
    """Items of one part, by number: their distinct terms and how often each has them."""

    def __init__(self, items: list[tuple[int, Counter]]):
        self.numbers = [n for n, _ in items]
        self.terms = sorted(set().union(*[c for _, c in items]))
        self.place = {t: k for k, t in enumerate(self.terms)}
        self.rows = [np.array([self.place[t] for t in c], np.int64) for _, c in items]
        self.counts = [np.array(list(c.values()), np.int64) for _, c in items]

    def weigh(self, n_docs: int, n_terms: int, holding: dict[int, int]) -> None:
        """``holding``: by place, the documents that hold the term."""
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(k, 0) + 1))) for k in range(len(self.terms))], np.int64)
        self.gains = [c * self.weight[r] for r, c in zip(self.rows, self.counts, strict=True)]
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], np.uint64)
        self.asks: list[list[tuple[int, int]]] = [[] for _ in self.terms]
        for k, (rows, gains) in enumerate(zip(self.rows, self.gains, strict=True)):
            for r, g in zip(rows.tolist(), gains.tolist(), strict=True):
                self.asks[r].append((k, g))

    def bounds(self, row: dict) -> np.ndarray:
        """(items, documents): no score of a document of the block is higher."""
        lengths = np.frombuffer(row["lengths"], np.int64)
        m, n = length_figure(lengths, self.n_docs, self.n_terms), len(lengths)
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
        out, before = np.zeros((len(self.rows), n)), np.zeros(n, np.int64)
        alive = np.arange(len(self.terms))
        so_far = np.full((len(alive), slices.shape[1]), 255, np.uint8)
        for level, least in enumerate(LEVELS):
            bits = _bits(_entries(self.hashes[alive], level), row["width"])
            for h in range(HASHES):
                so_far &= slices[bits[:, h]]
            some = so_far.any(1)
            alive, so_far = alive[some], so_far[some]
            if not len(alive):
                break
            # So often, and not as often as the next level says; at the last level as often as it has terms.
            most = np.minimum(lengths, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else lengths
            most = np.where(lengths < least, 0, most)
            now = np.maximum(part_of_score(most, m), before)
            at = np.full(len(self.terms), -1)
            at[alive] = np.arange(len(alive))
            grid = np.unpackbits(so_far, axis=1, count=n).astype(np.float64)
            for k, (rows, gains) in enumerate(zip(self.rows, self.gains, strict=True)):
                there = at[rows]
                out[k] += (gains[there >= 0] @ grid[there[there >= 0]]) * (now - before)
            before = now
        return out

    def scores(self, words: list[bytes]) -> dict[int, int]:
        """Exact scores above 0 of a document, by item."""
        count = Counter(words)
        m = length_figure(len(words), self.n_docs, self.n_terms)
        found: dict[int, int] = {}
        for t in count.keys() & self.place.keys():
            part = part_of_score(count[t], m)
            for k, gain in self.asks[self.place[t]]:
                found[k] = found.get(k, 0) + gain * part
        return {k: s for k, s in found.items() if s > 0}


def _parts(items: DataFrame, text: str) -> Iterator[_Part]:
    part: list[tuple[int, Counter]] = []
    seen: set[bytes] = set()
    for row in items.select("number", F.col(text).alias("text")).orderBy("number").toLocalIterator():
        count = Counter(terms((row["text"] or "").encode()))
        if part and (len(part) == PART_ITEMS or len(seen | count.keys()) > PART_TERMS):
            yield _Part(part)
            part, seen = [], set()
        if count:
            part.append((row["number"], count))
            seen |= count.keys()
    if part:
        yield _Part(part)


def _holding(docs: DataFrame, part) -> dict[int, int]:
    """Documents that hold each term of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, found = part.value.place, Counter()
        for batch in batches:
            for raw in raw_bytes(batch.column(0)):
                found.update(place.keys() & set(terms(raw)))
        yield pa.RecordBatch.from_arrays([pa.array([place[t] for t in found], pa.int64()), pa.array(list(found.values()), pa.int64())], names=["place", "n"])

    counted = docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    return {r["place"]: r["n"] for r in counted.collect()}


class _Best:
    """The ``keep`` best (score, id) per item so far, ids that are NULL last."""

    def __init__(self, keep: int):
        self.keep, self.least = keep, {}
        self.rows: list[tuple] = []

    def add(self, item: int, score: int, i: int | None) -> None:
        if score >= self.least.get(item, 0):
            self.rows.append((item, -score, i is None, i or 0))
            if len(self.rows) > 200_000:
                self.cut()

    def cut(self) -> None:
        self.rows.sort()
        kept, item, n = [], None, 0
        for row in self.rows:
            n = n + 1 if row[0] == item else 1
            item = row[0]
            if n <= self.keep:
                kept.append(row)
            if n == self.keep:
                self.least[item] = -row[1]
        self.rows = kept

    def batch(self) -> pa.RecordBatch:
        self.cut()
        columns = list(zip(*[(k, None if none else i, -s) for k, s, none, i in self.rows], strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["item", "id", "score"])


RANKED = "item long, id long, score long"


def _highest_bounds(index: DataFrame, part, keep: int) -> DataFrame:
    """Per item and task the documents with the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(keep)
        for batch in batches:
            for row in batch.to_pylist():
                bounds = part.value.bounds(row).astype(np.int64)
                for k, b in enumerate(bounds):
                    at = np.flatnonzero(b >= max(1, best.least.get(k, 0)))
                    if len(at) > keep:
                        at = at[np.argpartition(-b[at], keep - 1)[:keep]]
                    for j in at.tolist():
                        best.add(k, int(b[j]), row["ids"][j])
                best.cut()
        yield best.batch()

    return index.mapInArrow(run, RANKED)


def _reaching(index: DataFrame, part, thresholds: np.ndarray) -> DataFrame:
    """Documents whose bound reaches the threshold of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                some = (part.value.bounds(row) >= thresholds[:, None]).any(0)
                yield pa.RecordBatch.from_arrays([pa.array([row["ids"][j] for j in np.flatnonzero(some).tolist()], pa.int64())], names=["id"])

    return index.mapInArrow(run, "id long")


def _scored(docs: DataFrame, part, chosen, thresholds: np.ndarray, keep: int) -> DataFrame:
    """Per item and task the best of the chosen documents, scored from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(keep)
        for batch in batches:
            at = np.flatnonzero(holds(chosen.value, np.asarray(batch.column(1))))
            own = batch.take(pa.array(at))
            for i, raw in zip(own.column(0).to_pylist(), raw_bytes(own.column(2)), strict=True):
                for k, score in part.value.scores(terms(raw)).items():
                    if score >= thresholds[k]:
                        best.add(k, score, i)
        yield best.batch()

    return docs.select("id", key_of("id").alias("key"), "text").mapInArrow(run, RANKED)


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """Adds ``rank``; Spark cuts each window to ``keep`` rows before it shuffles."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def search(
    docs: DataFrame,
    index: DataFrame,
    items: DataFrame,
    most: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``most`` documents of each item with the highest scores above 0.

    ``index`` is what ``build`` stored of the same ``docs``.
    """
    spark = docs.sparkSession
    importable(spark)
    stored = Scratch(spark, "search").store
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sizes = index.select(F.size("ids").cast("long").alias("n"), "lengths")
    n_docs = sizes.agg(F.sum("n")).first()[0] or 0
    n_terms = _terms_in(spark, sizes)
    asked = stored(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).withColumn("number", F.monotonically_increasing_id()), "items")
    kind = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for one in _parts(asked, "text") if n_docs else ():
        one.weigh(n_docs, n_terms, _holding(rows, spark.sparkContext.broadcast(one)))
        part = spark.sparkContext.broadcast(one)
        seeds = _ranked(_highest_bounds(index, part, SEEDS * most), SEEDS * most)
        lowest = np.ones(len(one.numbers), np.int64)
        first = spark.sparkContext.broadcast(marked(seeds.select(key_of("id").alias("key"))))
        for r in _ranked(_scored(rows, part, first, lowest, most), most).where(F.col("rank") == most).collect():
            lowest[r["item"]] = max(1, r["score"])
        reaching = marked(_reaching(index, part, lowest).select(key_of("id").alias("key")))
        chosen = spark.sparkContext.broadcast(reaching)
        best = stored(_ranked(_scored(rows, part, chosen, lowest, most), most), "ranked")
        numbers = spark.createDataFrame(list(enumerate(one.numbers)), "item long, number long")
        named = best.join(numbers, "item").join(asked.select("number", "item_id"), "number")
        out = out.unionByName(named.select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return out


def _terms_in(spark: SparkSession, sizes: DataFrame) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = sum(int(np.frombuffer(x, np.int64).sum()) for x in batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["n"])

    return sizes.select("lengths").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
