"""Fuzzy search for short licence notices.

Texts are folded to words (see ``words``). A notice of n letters may have k = n // ``LETTERS_PER_EDIT``
edits. Cut into k + 1 pieces, every such occurrence holds one piece unchanged (pigeonhole): an
Aho-Corasick scan for all pieces gives the places, and the regex library's bounded-error matching
verifies edits there and reports spans. Exact places of the four base phrases are counted in words.

Defined results: a NULL or empty text has no words, no labels and score 0; overlapping places of a
phrase all count; of overlapping spans of one notice the one with the fewest edits, then the first, stays.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindergrid.llm.words import Original, folded, importable, n_words, raw_bytes

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices and their labels, folded.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license": "apache",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
LETTERS_PER_EDIT = 10

SPAN = T.StructType(
    [
        T.StructField("label", T.StringType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("end", T.LongType(), False),
        T.StructField("edits", T.IntegerType(), False),
        T.StructField("score", T.DoubleType(), False),
    ]
)
_ARROW_SPAN = pa.struct(
    [
        pa.field("label", pa.string(), False),
        pa.field("start", pa.int64(), False),
        pa.field("end", pa.int64(), False),
        pa.field("edits", pa.int32(), False),
        pa.field("score", pa.float64(), False),
    ]
)
SCHEMA = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def edits_allowed(notice: str) -> int:
    return len(notice) // LETTERS_PER_EDIT


def pieces(notice: str) -> list[tuple[int, str]]:
    """The notice cut into one piece more than edits: (offset, piece)."""
    k = edits_allowed(notice)
    edges = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


class Finder:
    """The compiled search; one per worker."""

    def __init__(self, notices: dict[str, str]):
        import ahocorasick
        import regex

        self.notices = list(notices.items())
        self.patterns = [regex.compile(f"(?:{regex.escape(n)}){{e<={edits_allowed(n)}}}", regex.ENHANCEMATCH) for n, _ in self.notices]
        of: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(self.notices):
            for offset, piece in pieces(notice):
                of.setdefault(piece, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, places in of.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def spans(self, line: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in the line."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.seeds.iter(line):
            for i, offset in places:
                notice = self.notices[i][0]
                slack = edits_allowed(notice)
                a = max(0, end + 1 - length - offset - slack)
                b = end + 1 - length - offset + len(notice) + slack
                own = windows.setdefault(i, [])
                if own and a <= own[-1][1]:
                    own[-1][1] = max(b, own[-1][1])
                    own[-1][0] = min(a, own[-1][0])
                else:
                    own.append([a, b])
        found = []
        for i, own in windows.items():
            for a, b in own:
                for m in self.patterns[i].finditer(line, a, min(b, len(line))):
                    start, end = m.span()
                    while start < end and line[start] == " ":
                        start += 1
                    while end > start and line[end - 1] == " ":
                        end -= 1
                    if end > start:
                        found.append((sum(m.fuzzy_counts), start, end, i))
        kept: list[tuple[int, int, int, int]] = []
        # Spans of one notice never overlap, so only the neighbours of a new one can.
        taken: dict[int, list[tuple[int, int]]] = {}
        for edits, start, end, i in sorted(found):
            own = taken.setdefault(i, [])
            at = bisect.bisect_left(own, (start, end))
            if not (at and start < own[at - 1][1]) and not (at < len(own) and own[at][0] < end):
                own.insert(at, (start, end))
                kept.append((i, start, end, edits))
        return sorted(kept, key=lambda s: (s[1], s[2], s[0]))


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand consecutively."""
    out = []
    for phrase, label in PHRASES.items():
        wanted = f" {phrase} ".encode()
        at, word, before = line.find(wanted), 0, 0
        while at >= 0:
            word, before = word + line.count(b" ", before, at), at
            out.append((word, label))
            at = line.find(wanted, at + 1)
    return out


_finders: dict[tuple, Finder] = {}


def find_notices(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: dict[str, str] | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, spans``; spans in code points."""
    importable(docs.sparkSession)
    wanted = dict(NOTICES if notices is None else notices)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *SCHEMA.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(wanted.items())
        finder = _finders.get(key)
        if finder is None:
            finder = _finders[key] = Finder(wanted)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in SCHEMA.names}
            for raw in raw_bytes(batch.column(1)):
                line = folded(raw)
                base = base_places(line)
                found = finder.spans(line.decode("latin-1"))
                at = Original(raw, line) if found else None
                out["n_words"].append(n_words(line) if len(line) > 1 else 0)
                out["n_base"].append(len(base))
                out["first_word"].append(min((w for w, _ in base), default=None))
                out["last_word"].append(max((w for w, _ in base), default=None))
                out["base_labels"].append(sorted({x for _, x in base}))
                out["spans"].append(
                    [
                        {
                            "label": finder.notices[i][1],
                            "start": at.code_point(a),
                            "end": at.code_point(b - 1) + 1,
                            "edits": edits,
                            "score": 1 - edits / len(finder.notices[i][0]),
                        }
                        for i, a, b, edits in found
                    ]
                )
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(_ARROW_SPAN)]
            arrays = [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *SCHEMA.names])

    return rows.mapInArrow(run, schema)
