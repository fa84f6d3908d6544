"""Removal of passages that an earlier document has, by prefix-free parsing.

A passage is a string of ``LENGTH`` bytes; a byte goes if such a string covers it and also starts in a
document with a smaller id, judged on the input. Texts are UTF-8 bytes; passages never cross documents.

1. Parse. A rolling hash of ``TRIGGER`` bytes cuts each text into phrases where it is 0 modulo
   ``PHRASE``. A phrase stands for the passages that start in it, so its string reaches ``LENGTH`` - 1
   bytes into the next one. Equal phrases are one entry of the dictionary, owned by the least document.
   In highly repetitive text most phrases are owned by someone else: all their passages go at once.
2. Anchors. The least hash of the ``GRAM``-byte strings in a passage depends on the passage alone, so two
   equal passages have the same anchor. Only anchors in two different phrases or more lead on: what
   lies within equal phrases is settled by step 1.
3. Dictionary order. The suffixes of owned phrases that begin with a shared anchor's passage are sorted by
   the names of their first ``LENGTH`` bytes (two rolling hashes, 96 bits), and each group of equals gets its
   least owner. Passages that follow each other are sent as their bytes, which their bucket names again: a passage more
   is a byte more, not a name. Parse and dictionary combine: a document loses the passages of phrases it doesn't
   own, and those of its own phrases that a smaller owner has.

All three passes read the texts anew and exchange blocks of hashes. What a task knows by itself (a phrase,
anchor or passage that it has seen in a smaller document) it answers by itself; only its least document
goes on, so a passage in a third of all documents costs a bucket one entry per task.

Defined results: a NULL or empty text has 0 bytes, and texts below ``LENGTH`` bytes lose none; a document with
a NULL id neither loses nor takes; rows that share an id never count as earlier than each other.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.llm.blocks import BLOCK, packed, planes, rows_of, unpacked, unplaned
from cindergrid.llm.shingles import mixed, powers
from cindergrid.llm.words import importable, raw_bytes, slices
from cindergrid.session import work_folder

LENGTH = 50
GRAM = 20
TRIGGER = 12
PHRASE = 128
#: Texts are parsed by parts of at most so many bytes; a cut between parts only ends a phrase early.
PART = 1 << 19
#: Text of one block of documents in a task, and entries of one bucket.
PIECE = 1 << 20
BUCKET_ROWS = 1_000_000

_BASES = [0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1]
_rng = np.random.default_rng(50)
_BYTES = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) for _ in _BASES]


class Parsed:
    """Phrases, anchors and passages of some texts, side by side."""

    def __init__(self, docs: list[int], raws: list[bytes]):
        parts, owners, offsets = [], [], []
        for doc, raw in zip(docs, raws, strict=True):
            for a in range(0, max(1, len(raw) - LENGTH + 1), PART):
                parts.append(raw[a : a + PART + LENGTH - 1])
                owners.append(doc)
                offsets.append(a)
        self.owners, self.offsets = np.array(owners, np.int64), np.array(offsets, np.int64)
        sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.n = len(self.data)
        # Where a passage starts, and in which part.
        counts = np.maximum(sizes - LENGTH + 1, 0)
        self.part = np.repeat(np.arange(len(parts)), counts)
        firsts = np.cumsum(counts) - counts
        self.at = np.arange(counts.sum()) - np.repeat(firsts - self.begins, counts)
        self.sums = [self._sums(k) for k in range(2)]

    def _sums(self, k: int) -> np.ndarray:
        out = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_BYTES[k][self.data] * powers(f"up{k}", np.uint64(_BASES[k]), self.n), out=out[1:])
        return out

    def _hash(self, a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
        """Of the bytes from a to b, exclusive."""
        down = powers(f"down{k}", np.uint64(pow(_BASES[k], -1, 1 << 64)), self.n)
        return mixed((self.sums[k][b] - self.sums[k][a]) * down[a] + (b - a).astype(np.uint64))

    def doc(self) -> np.ndarray:
        """Of each passage."""
        return self.owners[self.part]

    def anchors(self) -> np.ndarray:
        """Of each passage: the least hash of its grams."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        where = np.arange(self.n - GRAM + 1)
        least = self._hash(where, where + GRAM, 0)
        wide, span = LENGTH - GRAM + 1, 1
        while 2 * span <= wide:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        if span < wide:
            least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
        return least[self.at]

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First passage (by place in ``at``), and two hashes of the phrase's string."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        trigger = self._hash(self.at, self.at + TRIGGER, 1) % np.uint64(PHRASE) == 0
        trigger[0] = True
        trigger[1:] |= self.part[1:] != self.part[:-1]
        first = np.flatnonzero(trigger)
        last = np.append(first[1:], len(self.at)) - 1
        a, b = self.at[first], self.at[last] + LENGTH
        return first, self._hash(a, b, 0), self._hash(a, b, 1)

    def names(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the passages at these places of ``at``."""
        a = self.at[some]
        return self._hash(a, a + LENGTH, 0), self._hash(a, a + LENGTH, 1) & np.uint64(0xFFFFFFFF)


def _documents(piece: pa.RecordBatch) -> tuple[list[int], list[bytes], list[int]]:
    """Ids, texts and places of the rows that can have a passage."""
    ids, raws = piece.column(0).to_pylist(), raw_bytes(piece.column(1))
    use = [i for i, (d, r) in enumerate(zip(ids, raws, strict=True)) if d is not None and r is not None and len(r) >= LENGTH]
    return [ids[i] for i in use], [raws[i] for i in use], use


# What a block of hashes is about; RUNS has bytes in place of the names of passages.
PHRASES, ANCHORS, PASSAGES, RUNS = 0, 1, 2, 3


def _least(kind: int, key: np.ndarray, extra: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(answered, sent): places of ``key`` whose question is answered here, and those to pass on.

    A phrase or passage is answered for every document above the least, and the least goes on. An anchor
    (``extra`` names the phrase it stands in) is answered, for the least document of each phrase, once there
    are two phrases; two of them go on, which is enough to tell everyone else.
    """
    order = np.lexsort((doc, extra, key))
    k, e, d = key[order], extra[order], doc[order]
    if not len(k):
        return order, order
    new_key = np.concatenate([[True], k[1:] != k[:-1]])
    new_pair = new_key.copy()
    new_pair[1:] |= e[1:] != e[:-1]
    if kind != ANCHORS:
        new = new_pair.copy()
        new[1:] |= d[1:] != d[:-1]
        return order[new & ~new_pair], order[new_pair]
    order, first = order[new_pair], np.flatnonzero(new_key[new_pair])
    sizes = np.diff(np.append(first, len(order)))
    place = np.arange(len(order)) - np.repeat(first, sizes)
    return order[np.repeat(sizes, sizes) > 1], order[place < 2]


def _questions(kind: int, key: np.ndarray, extra: np.ndarray, doc: np.ndarray, n_buckets: int) -> Iterator[tuple]:
    """Rows of blocks: answers by document (bucket below 0), questions by key."""
    answered, sent = _least(kind, key, extra, doc)
    yield from _answers(kind, key[answered], doc[answered], n_buckets)
    key, extra, doc = key[sent], extra[sent], doc[sent]
    to = (key >> np.uint64(20)) % np.uint64(n_buckets)
    yield from packed(kind, to, key, extra, doc)


def _answers(kind: int, key: np.ndarray, doc: np.ndarray, n_buckets: int) -> Iterator[tuple]:
    to = doc.view(np.uint64) % np.uint64(n_buckets)
    for row in packed(kind, to, key, np.zeros(len(key), np.uint64), doc):
        yield (-1 - row[0], *row[1:])


def _runs(parsed: Parsed, some: np.ndarray, anchors: np.ndarray, n_buckets: int) -> Iterator[tuple]:
    """Rows of blocks with the bytes of the passages ``some`` (places, ascending), side by side where they share an anchor."""
    if not len(some):
        return
    new = np.concatenate([[True], np.diff(some) != 1])
    new[1:] |= (anchors[some[1:]] != anchors[some[:-1]]) | (parsed.part[some[1:]] != parsed.part[some[:-1]])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(some))) + LENGTH - 1
    first = some[first]
    bucket = ((anchors[first] >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, sizes, bucket, doc = first[order], sizes[order], bucket[order], parsed.doc()[first[order]]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0, [True]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        n = sizes[a:b]
        at = np.arange(n.sum()) + np.repeat(parsed.at[first[a:b]] - np.cumsum(n) + n, n)
        docs, owner = np.unique(doc[a:b], return_inverse=True)
        yield int(bucket[a]), RUNS, parsed.data[at].tobytes(), planes(n.astype(np.uint32)), planes(owner.astype(np.uint32)), planes(docs)


def _asked(block: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind: keys, extras and documents of a block's questions; runs are named passage by passage."""
    if block["kind"][0].as_py() != RUNS:
        yield from unpacked(block)
        return
    found = []
    for raw, sizes, owner, docs in zip(*[block[n].to_pylist() for n in ("keys", "extras", "owners", "docs")], strict=True):
        ends = np.cumsum(unplaned(sizes, np.uint32).astype(np.int64))
        doc = unplaned(docs, np.int64)[unplaned(owner, np.uint32)]
        edges = [0, *(np.flatnonzero(np.diff(ends // PIECE)) + 1).tolist(), len(ends)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                begins = [ends[a - 1] if a else 0, *ends[a : b - 1]]
                parsed = Parsed(doc[a:b].tolist(), [raw[x:y] for x, y in zip(begins, ends[a:b], strict=True)])
                key, extra = parsed.names(np.arange(len(parsed.at)))
                found.append((key, extra, parsed.doc()))
    yield PASSAGES, *[np.concatenate(x) for x in zip(*found, strict=True)]


def _exchange(questions: DataFrame, n_buckets: int) -> DataFrame:
    """``doc_id``, ``kind`` and ``keys`` (sorted u64) of all answers, one row per document and kind."""

    def answer(block: pa.Table) -> pa.Table:
        bucket = block["bucket"][0].as_py()
        if bucket < 0:  # answered already: pass on
            return block
        out = []
        for kind, key, extra, doc in _asked(block):
            answered, _ = _least(kind, key, extra, doc)
            out += list(_answers(kind, key[answered], doc[answered], n_buckets))
        return rows_of(out)

    def gather(block: pa.Table) -> pa.Table:
        ids, kinds, keys = [], [], []
        for kind, key, _, doc in unpacked(block):
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            edges = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(doc) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                ids.append(int(doc[a]))
                kinds.append(kind)
                keys.append(np.unique(key[a:b]).tobytes())
        return pa.table(
            [pa.array(ids, pa.int64()), pa.array(kinds, pa.int32()), pa.array(keys, pa.binary())], names=["doc_id", "kind", "keys"]
        )

    answers = questions.groupBy("bucket").applyInArrow(answer, BLOCK)
    return answers.groupBy("bucket").applyInArrow(gather, "doc_id long, kind int, keys binary")


def _among(values: np.ndarray, keys: bytes | None) -> np.ndarray:
    if not keys or not len(values):
        return np.zeros(len(values), bool)
    known = np.frombuffer(keys, np.uint64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _first_pass(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Questions about all phrases and anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                ids, raws, _ = _documents(piece)
                if not ids:
                    continue
                parsed = Parsed(ids, raws)
                doc = parsed.doc()
                first, a, b = parsed.phrases()
                out = list(_questions(PHRASES, a, b, doc[first], n_buckets))
                anchors = parsed.anchors() & np.uint64((1 << 48) - 1)
                new = np.concatenate([[True], anchors[1:] != anchors[:-1]])
                new[first] = True
                phrase = a[np.searchsorted(first, np.flatnonzero(new), side="right") - 1] & np.uint64(0xFFFFFFFF)
                out += list(_questions(ANCHORS, anchors[new], phrase, doc[new], n_buckets))
                yield from rows_of(out).to_batches()

    return docs.mapInArrow(run, BLOCK)


def _second_pass(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Questions about the passages of owned phrases with a shared anchor; docs have ``phrases, anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                ids, raws, use = _documents(piece)
                if not ids:
                    continue
                parsed = Parsed(ids, raws)
                doc, anchors = parsed.doc(), parsed.anchors() & np.uint64((1 << 48) - 1)
                first, a, _ = parsed.phrases()
                phrase = np.zeros(len(doc), np.int64)
                phrase[first[1:]] = 1
                phrase = np.cumsum(phrase)
                ask = np.zeros(len(doc), bool)
                edges = _edges(parsed, len(ids))
                for k, i in enumerate(use):
                    mine = slice(*edges[k])
                    shared = _among(anchors[mine], piece.column(3)[i].as_py())
                    if shared.any():
                        owned = ~_among(a[phrase[mine]], piece.column(2)[i].as_py())
                        ask[mine] = shared & owned
                some = np.flatnonzero(ask)
                if len(some):
                    key, extra = parsed.names(some)
                    answered, sent = _least(PASSAGES, key, extra, doc[some])
                    out = list(_answers(PASSAGES, key[answered], doc[some[answered]], n_buckets))
                    out += list(_runs(parsed, np.sort(some[sent]), anchors, n_buckets))
                    yield from rows_of(out).to_batches()

    return docs.mapInArrow(run, BLOCK)


def _edges(parsed: Parsed, n_docs: int) -> list[tuple[int, int]]:
    """Places in ``at`` of each text; its parts stand side by side."""
    text = np.cumsum(parsed.offsets == 0) - 1
    counts = np.bincount(text[parsed.part], minlength=n_docs)
    ends = np.cumsum(counts)
    return list(zip((ends - counts).tolist(), ends.tolist(), strict=True))


def removed(parsed: Parsed, mine: slice, gone: np.ndarray, n_bytes: int) -> np.ndarray:
    """Which bytes of a text are covered by the passages of ``mine`` that are gone."""
    part = parsed.part[mine]
    at = parsed.at[mine] - parsed.begins[part] + parsed.offsets[part]
    step = np.zeros(n_bytes + 1, np.int64)
    np.add.at(step, at[gone], 1)
    np.add.at(step, at[gone] + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _third_pass(docs: DataFrame, keep_bytes: bool) -> DataFrame:
    """Results per row; docs have ``phrases, passages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                raws = [r or b"" for r in raw_bytes(piece.column(1))]
                results: list[tuple] = [(len(r), 0, 0, hashlib.sha256(r).hexdigest(), r if keep_bytes else None) for r in raws]
                ids, texts, use = _documents(piece)
                asked = [k for k, i in enumerate(use) if piece.column(2)[i].is_valid or piece.column(3)[i].is_valid]
                if asked:
                    parsed = Parsed([ids[k] for k in asked], [texts[k] for k in asked])
                    first, a, _ = parsed.phrases()
                    edges = _edges(parsed, len(asked))
                    phrase = np.zeros(len(parsed.at), np.int64)
                    phrase[first[1:]] = 1
                    phrase = np.cumsum(phrase)
                    for j, k in enumerate(asked):
                        i, mine, raw = use[k], slice(*edges[j]), texts[k]
                        gone = _among(a[phrase[mine]], piece.column(2)[i].as_py())
                        if piece.column(3)[i].is_valid:
                            some = np.flatnonzero(~gone) + edges[j][0]
                            gone[some - edges[j][0]] = _among(parsed.names(some)[0], piece.column(3)[i].as_py())
                        lost = removed(parsed, mine, gone, len(raw))
                        kept = np.frombuffer(raw, np.uint8)[~lost].tobytes()
                        spans = int(lost[0]) + int(np.count_nonzero(lost[1:] & ~lost[:-1]))
                        results[i] = (len(raw), int(lost.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None)
                columns = list(zip(*results, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return docs.mapInArrow(run, f"doc_id long, {RESULT}")


def _free(spark: SparkSession) -> None:
    """Shuffle files of a finished job stay on disk until the driver collects its garbage: do it now."""
    gc.collect()
    spark._jvm.System.gc()


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_bytes: bool = True) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the ``kept`` bytes if asked for."""
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def stored(found: DataFrame) -> DataFrame:
        path = work_folder(spark, "suffix-answers")
        found.write.parquet(path)
        return spark.read.parquet(path)

    def of(found: DataFrame, kind: int, name: str) -> DataFrame:
        return found.where(F.col("kind") == kind).select("doc_id", F.col("keys").alias(name))

    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_buckets = max(1, -(-int(total) // (BUCKET_ROWS * 12)))
    found = stored(_exchange(_first_pass(rows, n_buckets), n_buckets))
    _free(spark)
    phrases, anchors = of(found, PHRASES, "phrases"), of(found, ANCHORS, "anchors")
    asked = rows.join(anchors.join(phrases, "doc_id", "left"), "doc_id").select("doc_id", "text", "phrases", "anchors")
    passages = of(stored(_exchange(_second_pass(asked, n_buckets), n_buckets)), PASSAGES, "passages")
    _free(spark)
    lost = phrases.join(passages, "doc_id", "full_outer")
    out = _third_pass(rows.join(lost, "doc_id", "left").select("doc_id", "text", "phrases", "passages"), keep_bytes)
    return out if keep_bytes else out.drop("kept")
