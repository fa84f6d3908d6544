"""Token ids as directly addressable codes: any token without decoding a block.

A segment holds the ids of some whole documents. Ids are cut into chunks of eight bits. Level 0 has
the lowest chunk of every id; a continuation bit says whether the id goes on in level 1, at the place
given by the number of set bits before it, and so on. A rank directory has those numbers for every
512th bit, so one look at it and one popcount of at most 512 bits find the place.

Payload, little-endian: magic ``DAC1``, levels u32, ids u32, documents u32, document starts
u32 x (documents + 1); then per level: entries u32, chunks u8 x entries, and, but for the last level,
bitmap u8 x ceil(entries / 8), ranks u32 x (ceil(entries / 512) + 1).

On disk: ``<path>/segments`` (Parquet, one row per segment, a bounded number of ids each) and
``<path>/directory`` (part, seq, first id's global place). Spark's committer makes lost or repeated tasks
harmless. Documents are range-partitioned by id, so a part is a run of ids and no task sees them all.

Defined results: a NULL or empty text has the end id alone; NULL doc_ids come first; repeated rows are
written as often as they occur, equal ids in order of their text; an empty table writes no segment.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cindergrid.llm.words import importable, slices

END_ID = 2
#: A segment is closed once it has as many ids; a single longer document is a segment of its own.
SEGMENT_IDS = 1 << 20
#: Remembered pieces (words) per worker, some 200 bytes each: two generations of half as many. When the younger
#: is full it becomes the older one, from which a piece is fetched back when it is met again.
MEMO_PIECES = 1_200_000
_MAGIC = b"DAC1"
_RANK = 512
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(ids: np.ndarray, starts: list[int]) -> bytes:
    """``ids`` (uint32) of the documents that begin at ``starts``, as one payload."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        last = not more.any()
        levels.append(((rest & 255).astype(np.uint8), None if last else more))
        if last:
            break
        rest = rest[more] >> 8
    out = [_MAGIC, struct.pack("<III", len(levels), len(ids), len(starts)), np.array([*starts, len(ids)], "<u4").tobytes()]
    for chunks, more in levels:
        out += [struct.pack("<I", len(chunks)), chunks.tobytes()]
        if more is not None:
            bits = np.packbits(more, bitorder="little")
            padded = np.zeros(-(-len(more) // _RANK) * _RANK, bool)
            padded[: len(more)] = more
            ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, _RANK).sum(axis=1))])
            out += [bits.tobytes(), ranks.astype("<u4").tobytes()]
    return b"".join(out)


class Segment:
    """Reads a payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a segment of token codes")
        n_levels, self.n_ids, self.n_docs = struct.unpack_from("<III", payload, 4)
        at = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.starts = take("<u4", self.n_docs + 1)
        self.levels = []
        for k in range(n_levels):
            n = int(take("<u4", 1)[0])
            chunks = take("u1", n)
            more = (take("u1", -(-n // 8)), take("<u4", -(-n // _RANK) + 1)) if k < n_levels - 1 else None
            self.levels.append((chunks, more))

    def token(self, i: int) -> int:
        """The i-th id, through the rank directories alone."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, more) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if more is None or not more[0][i >> 3] >> (i & 7) & 1:
                return value
            i = self._rank(more, i)
        return value

    @staticmethod
    def _rank(more: tuple[np.ndarray, np.ndarray], i: int) -> int:
        """Set bits before bit i."""
        bits, ranks = more
        block = i // _RANK
        whole = int(_POPCOUNT[bits[block * _RANK // 8 : i >> 3]].sum())
        return int(ranks[block]) + whole + bin(int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).count("1")

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b, exclusive; each level is one run of its chunks."""
        out = np.zeros(b - a, "<u4")
        where = np.arange(b - a)
        for k, (chunks, more) in enumerate(self.levels):
            if not len(where):
                break
            out[where] |= chunks[a:b].astype("<u4") << np.uint32(8 * k)
            if more is None:
                break
            on = np.unpackbits(more[0][a >> 3 : -(-b // 8)], bitorder="little")[a & 7 :][: b - a].astype(bool)
            where, a = where[on], self._rank(more, a) if a < len(chunks) else 0
            b = a + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


class _Memo(dict):
    """Ids of strings, made when first asked for. ``turn`` forgets what a generation has not asked for."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        self[key] = found = self.make(key) if found is None else found
        return found

    def turn(self, most: int) -> None:
        if len(self) > most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """A tokenizer with a bounded memory of words.

    A text of ASCII and Latin letters is cut into words as the byte-level pre-tokenizer does, and each word goes to the
    tokenizer's model once. Other texts are cut at single spaces, each going with what follows it, which the
    pre-tokenizer never joins with what stands before. Where white space stands on both sides of a space there, or a
    special token occurs, the whole text is encoded.
    """

    _APART = re.compile(r"\s \s")
    _LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
    _PLAIN = re.compile(f"[\\t-\\r -~{_LATIN}]*")
    _WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\\s{_LATIN}0-9]+|\\s+(?!\\S)|\\s+", re.ASCII)

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Memo(self._word)
        from tokenizers.pre_tokenizers import ByteLevel

        pre = self.tokenizer.pre_tokenizer
        self.byte_level = isinstance(pre, ByteLevel) and not pre.add_prefix_space and pre.use_regex and self.tokenizer.normalizer is None
        # The letter that stands for each byte in the model's vocabulary.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {**{b: b for b in shown}, **{b: 256 + k for k, b in enumerate(hidden)}}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _word(self, word: str) -> bytes:
        if not self._PLAIN.fullmatch(word):
            return self._whole([word])[0]
        shown = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _cut(self, text: str) -> list[str]:
        if self._PLAIN.fullmatch(text):
            return self._WORDS.findall(text)
        first, *rest = text.split(" ")
        return [w for p in (first, *[" " + p for p in rest]) for w in (self._WORDS.findall(p) if self._PLAIN.fullmatch(p) else [p])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian u32."""
        done: dict[str, bytes] = {}
        for text in texts:
            if text not in done:
                special = not self.byte_level or any(s in text for s in self.special)
                if special or not self._PLAIN.fullmatch(text) and self._APART.search(text):
                    done[text] = self._whole([text])[0]
                else:
                    done[text] = b"".join(map(self.words.__getitem__, self._cut(text)))
                    self.words.turn(MEMO_PIECES // 2)
        return [done[t] for t in texts]


_encoders: dict[int, Encoder] = {}


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encodes every text and writes segments and directory below ``path``, in ascending doc_id order."""
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    key = definition._jbroadcast.id()
    tail = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(definition.value)
        encoder, part, seq = _encoders[key], TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list = []
        size, kind = 0, None

        def closed() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // 4 for x in ids]).tolist()
            payload = pack(np.frombuffer(b"".join(ids), "<u4"), [0, *ends[:-1]])
            columns = [pa.array([part]), pa.array([seq]), pa.array([len(ids)], pa.int64()), pa.array([size], pa.int64())]
            columns = [columns[0].cast(pa.int32()), columns[1].cast(pa.int32()), *columns[2:]]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([names], pa.list_(kind)), pa.array([payload], pa.binary())],
                names=["part", "seq", "n_docs", "n_ids", "doc_ids", "payload"],
            )

        for batch in batches:
            kind = batch.column(0).type
            for piece in slices(batch, "text"):
                texts = [t or "" for t in piece.column(1).to_pylist()]
                for name, found in zip(piece.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    ids.append(found + tail)
                    names.append(name)
                    size += len(found) // 4 + 1
                    if size >= segment_ids:
                        yield closed()
                        ids, names, size, seq = [], [], 0, seq + 1
        if ids:
            yield closed()

    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    schema = f"part int, seq int, n_docs long, n_ids long, doc_ids array<{id_type}>, payload binary"
    ordered.mapInArrow(encode, schema).write.parquet(f"{path}/segments")
    # Two levels: a window over the parts, one row each, and one within each part.
    light = spark.read.parquet(f"{path}/segments").select("part", "seq", "n_docs", "n_ids")
    parts = light.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).cast("long"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = light.withColumn("seq_start", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    placed.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("start")).write.parquet(
        f"{path}/directory"
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids_crc32``, from the files alone."""
    importable(spark)
    segments = spark.read.parquet(f"{path}/segments").join(spark.read.parquet(f"{path}/directory"), ["part", "seq"])
    rows = segments.select("doc_ids", "payload", "start")
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, payload, start in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                segment = Segment(payload.as_py())
                at = segment.starts.astype(np.int64)
                crcs = [zlib.crc32(segment.document(k).tobytes()) for k in range(segment.n_docs)]
                yield pa.RecordBatch.from_arrays(
                    [names.values, pa.array(start + at[:-1]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return rows.mapInArrow(decode, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document its ids: ``doc_id, ids array<long>``."""
    importable(spark)
    rows = spark.read.parquet(f"{path}/segments").select("doc_ids", "payload")
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, payload in zip(batch.column(0), batch.column(1), strict=True):
                segment = Segment(payload.as_py())
                ids = [segment.document(k).astype(np.int64) for k in range(segment.n_docs)]
                yield pa.RecordBatch.from_arrays([names.values, pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return rows.mapInArrow(decode, f"doc_id {id_type}, ids array<long>")
