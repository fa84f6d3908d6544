"""Hard negatives: per anchor and positive, the best rows of other labels inside a window of scores.

1. Vectors become integers. A Hilbert curve through all dimensions orders the rows; runs of that order are
   cut into blocks, each stored as one Parquet row with a zone map: the least and the greatest value of
   every dimension, and the labels that occur.
2. Interval arithmetic bounds the score of an anchor with any row of a block: the sum over the dimensions
   of the least (greatest) product of the anchor's value with the zone's two ends. Zone maps and groups of
   anchors meet in pages, without any vector of a block; only blocks whose bounds reach into a window of
   some anchor of the group go on.
3. Those blocks are read for the group, and every anchor scores only the blocks that its own bounds leave.
   A window's lower end rises to the last score it keeps, which leaves out further blocks.
4. This runs twice: for the positives (a window without upper end, whose lower end starts at what the
   anchor's own block holds), then for the windows that the positives' scores open. Both answers are exact.

Anchors are a stated query set; each group of some thousand meets each run of blocks once, so a task holds
one group and one run, of bounded size, however the values are spread. Equal vectors only make bounds equal.

Defined results: a row without id, label or vector, or with a NULL or non-finite component, takes no part,
nor does an anchor among its own rows; rows of equal id, label and whole values count once, rows that share
only the id are rows of their own; vectors are compared with those of their own length only, empty ones score 0;
equal scores go by the smaller id; an anchor with too few rows gets what there is; an empty table gives no
rows. Other columns are not read, whatever their names. Scores must fit 56 bits, else ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cindergrid.llm.scratch import Scratch
from cindergrid.llm.words import importable

SCALE = 256
#: Rows of a block, rows of a run of blocks, runs whose anchors form a group, runs of a page of zone maps.
BLOCK_ROWS = 256
RUN_ROWS = 8192
GROUP_RUNS = 40
PAGE_RUNS = 64
#: Bits of a Hilbert key, shared by the dimensions; one bit of each at least.
KEY_BITS = 128
NONE, ALL = np.iinfo(np.int64).min, np.iinfo(np.int64).max

ROWS = "dims int, key binary, id long, label long, anchor boolean, vector binary"
BLOCKS = "run int, block int, dims int, kinds array<long>, ids binary, labels binary, vectors binary, low binary, high binary, anchors binary, floors binary"
ANCHORS = "group int, dims int, a_run int, a_block int, places binary, ids binary, labels binary, vectors binary"
OPEN = "owners binary, lows binary, highs binary, tags binary, positive_ids binary, positive_scores binary"
FOUND = "a_run int, a_block int, place int, tag int, anchor_id long, positive_id long, positive_score long, id long, score long"


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Keys (rows of bytes) of points with ``bits`` bits a coordinate, after Skilling's transform (2004)."""
    x = points.astype(np.uint32).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(n):
            on = (x[i] & np.uint32(q)) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(on, p, swap).astype(np.uint32)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[n - 1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8), axis=0).T


def _vectors(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length of vectors: the length, the rows that have it and their whole values (as doubles)."""
    lists = batch.column(column)
    sizes = np.asarray(lists.value_lengths())
    starts = np.cumsum(sizes) - sizes
    flat = np.floor(SCALE * np.asarray(lists.flatten(), np.float64))
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        yield d, rows, flat[starts[rows][:, None] + np.arange(d)]


def _spread(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per length of vectors: rows, and least and greatest whole value of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, values in _vectors(batch, 0):
                low, high = [[float(len(at)), *v.tolist()] for v in (values.min(0), values.max(0))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array(low), pa.array(high)],
                    names=["dims", "at", "low", "high"],
                )

    each = rows.select("vector").mapInArrow(run, "dims int, at int, low double, high double")
    low = F.when(F.col("at") < 0, F.sum("low")).otherwise(F.min("low"))
    found = each.groupBy("dims", "at").agg(low.alias("low"), F.max("high").alias("high")).orderBy("dims", "at").collect()
    out: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for d in {r["dims"] for r in found}:
        mine = [r for r in found if r["dims"] == d]
        out[d] = int(mine[0]["low"]), np.array([r["low"] for r in mine[1:]]), np.array([r["high"] for r in mine[1:]])
    return out


def _keyed(rows: DataFrame, spread: dict, kind: np.dtype) -> DataFrame:
    """Rows with their Hilbert key and their whole values; rows repeated inside a batch go here already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, values in _vectors(batch, 3):
                _, low, high = spread[d]
                bits = max(1, min(8, KEY_BITS // max(d, 1)))
                cells = np.clip((values - low) / np.maximum(high - low, 1) * (1 << bits), 0, (1 << bits) - 1)
                keys = hilbert_keys(cells, bits) if d else np.zeros((len(at), 0), np.uint8)
                own = batch.take(pa.array(at)).columns[:3]
                raw = [v.tobytes() for v in values.astype(kind)]
                first = {row: k for k, row in reversed([*enumerate(zip(*[c.to_pylist() for c in own], raw, strict=True))])}
                columns = [pa.array([d] * len(at), pa.int32()), pa.array([k.tobytes() for k in keys], pa.binary()), *own, pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["dims", "key", "id", "label", "anchor", "vector"]).take(pa.array(sorted(first.values())))

    return rows.select("id", "label", "anchor", "vector").mapInArrow(run, ROWS)


def _blocked(keyed: DataFrame, kind: np.dtype, exact: type, positives: int) -> DataFrame:
    """Runs of the Hilbert order, cut into blocks with their zone maps."""

    def block(run: int, number: int, d: int, ids: list, labels: list, anchors: list, raw: list) -> tuple:
        values = np.frombuffer(b"".join(raw), kind).reshape(len(ids), d)
        ids, labels, anchors = np.array(ids, np.int64), np.array(labels, np.int64), np.array(anchors, bool)
        mine = np.flatnonzero(anchors)
        scores = (values[mine].astype(exact) @ values.astype(exact).T).astype(np.int64)
        scores[(labels[mine][:, None] != labels) | (mine[:, None] == np.arange(len(ids)))] = NONE
        kept = np.sort(scores, axis=1)[:, -positives] if len(ids) >= positives else np.full(len(mine), NONE)
        low, high = (values.min(0), values.max(0))
        return (
            run, number, d, sorted(set(labels.tolist())), ids.tobytes(), labels.tobytes(), values.tobytes(), low.tobytes(),
            high.tobytes(), anchors.tobytes(), kept.astype(np.int64).tobytes(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, last = TaskContext.get().partitionId(), 0, None
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            d, _, ids, labels, anchors, raw = zip(*rows, strict=True)
            one = block(part, number, d[0], list(ids), list(labels), list(anchors), list(raw))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 7]
            names = [f.split()[0] for f in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, kinds, strict=True)], names=names)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row == last:
                    continue
                if rows and (len(rows) == BLOCK_ROWS or rows[0][0] != row[0]):
                    yield out()
                    rows.clear()
                    number += 1
                rows.append(row)
                last = row
        if rows:
            yield out()

    return keyed.mapInArrow(run, BLOCKS)


def _anchors(blocks: DataFrame, kind: np.dtype) -> DataFrame:
    """The anchors of each block that has some, each with one window: from the score that its positives reach at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["anchors"], bool))
                if len(at):
                    values = np.frombuffer(r["vectors"], kind).reshape(len(r["ids"]) // 8, r["dims"])
                    ids, labels = (np.frombuffer(r[c], np.int64)[at] for c in ("ids", "labels"))
                    place, none = at.astype(np.int32), np.zeros(len(at), np.int64)
                    parts = [place, ids, labels, values[at], place, np.frombuffer(r["floors"], np.int64), none + ALL, none.astype(np.int32), none, none]
                    rows.append((r["run"] // GROUP_RUNS, r["dims"], r["run"], r["block"], *[p.tobytes() for p in parts]))
            kinds = [*[pa.int32()] * 4, *[pa.binary()] * 10]
            columns = list(zip(*rows, strict=True)) or [[]] * 14
            names = [f.split()[0] for f in f"{ANCHORS}, {OPEN}".split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return blocks.select("run", "block", "dims", "ids", "labels", "vectors", "anchors", "floors").mapInArrow(run, f"{ANCHORS}, {OPEN}")


class _Group:
    """Anchors of one group and their windows, side by side."""

    def __init__(self, rows: pa.Table, kind: np.dtype, exact: type):
        read = rows.to_pylist()
        self.d = read[0]["dims"]
        each = [np.frombuffer(r["places"], np.int32) for r in read]
        self.place = np.concatenate(each)
        self.run = np.repeat([r["a_run"] for r in read], [len(p) for p in each])
        self.block = np.repeat([r["a_block"] for r in read], [len(p) for p in each])
        whole = lambda c: np.concatenate([np.frombuffer(r[c], np.int64) for r in read])
        self.ids, self.labels = whole("ids"), whole("labels")
        self.values = np.concatenate([np.frombuffer(r["vectors"], kind).reshape(len(r["ids"]) // 8, self.d) for r in read]).astype(exact)
        before = np.cumsum([0, *[len(p) for p in each]])
        self.owner = np.concatenate([b + np.searchsorted(p, np.frombuffer(r["owners"], np.int32)) for r, p, b in zip(read, each, before, strict=False)])
        self.low, self.high, self.positive, self.positive_score = (whole(c).copy() for c in ("lows", "highs", "positive_ids", "positive_scores"))
        self.tag = np.concatenate([np.frombuffer(r["tags"], np.int32) for r in read])
        self.up, self.down = np.maximum(self.values, 0), np.minimum(self.values, 0)

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of every anchor with rows between ``low`` and ``high``."""
        return self.up @ low + self.down @ high, self.up @ high + self.down @ low

    def reached(self, low: np.ndarray, high: np.ndarray, kinds: np.ndarray, same: bool) -> np.ndarray:
        """The windows that rows of such a block can fall into."""
        least, most = self.bounds(low, high)
        labels = self.labels[self.owner]
        fits = np.isin(labels, kinds) if same else (labels != kinds[0]) | (len(kinds) > 1)
        return np.flatnonzero(fits & (most[self.owner] >= self.low) & (least[self.owner] <= self.high))


def _needed(zones: DataFrame, anchors: DataFrame, kind: np.dtype, exact: type, same: bool) -> DataFrame:
    """(group, dims, run, block): blocks that some window of the group may need, by zone maps alone."""
    last = zones.agg(F.max("run")).first()[0] or 0
    groups, pages = last // GROUP_RUNS + 1, last // PAGE_RUNS + 1
    left = zones.withColumns({"group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "page": F.floor(F.col("run") / PAGE_RUNS).cast("int")})
    right = anchors.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))

    def plan(blocks: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if blocks.num_rows and rows.num_rows:
            group = _Group(rows, kind, exact)
            for r in blocks.to_pylist():
                low, high = (np.frombuffer(r[c], kind).astype(exact) for c in ("low", "high"))
                if len(group.reached(low, high, np.array(r["kinds"]), same)):
                    out.append((r["group"], r["dims"], r["run"], r["block"]))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table([pa.array(list(c), pa.int32()) for c in columns], names=["group", "dims", "run", "block"])

    keys = ["group", "dims", "page"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(plan, "group int, dims int, run int, block int")


def _search(blocks: DataFrame, anchors: DataFrame, needed: DataFrame, kind: np.dtype, exact: type, same: bool, keep: int) -> DataFrame:
    """The ``keep`` best rows of each run in each window, read from the needed blocks."""
    chosen = blocks.select("run", "block", "dims", "kinds", "ids", "labels", "vectors", "low", "high").join(needed, ["run", "block", "dims"])
    asked = anchors.join(needed.select("group", "dims", "run").distinct(), ["group", "dims"])

    def score(found: pa.Table, rows: pa.Table) -> pa.Table:
        kinds = [*[pa.int32()] * 4, *[pa.int64()] * 5]
        names = [f.split()[0] for f in FOUND.split(", ")]
        if not found.num_rows or not rows.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        g = _Group(rows, kind, exact)
        window, value, row = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for r in sorted(found.to_pylist(), key=lambda r: r["block"]):
            low, high = (np.frombuffer(r[c], kind).astype(exact) for c in ("low", "high"))
            open_ = g.reached(low, high, np.array(r["kinds"]), same)
            if not len(open_):
                continue
            ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
            values = np.frombuffer(r["vectors"], kind).reshape(len(ids), g.d).astype(exact)
            who, slot = np.unique(g.owner[open_], return_inverse=True)
            s = (g.values[who] @ values.T).astype(np.int64)
            fits = labels == g.labels[who][:, None]
            if same:
                fits &= ~(((g.run[who] == r["run"]) & (g.block[who] == r["block"]))[:, None] & (g.place[who][:, None] == np.arange(len(ids))))
            else:
                fits = ~fits
            own = s[slot]
            w, at = np.nonzero(fits[slot] & (own >= g.low[open_][:, None]) & (own <= g.high[open_][:, None]))
            if not len(w):
                continue
            window, value, row = np.concatenate([window, open_[w]]), np.concatenate([value, own[w, at]]), np.concatenate([row, ids[at]])
            order = np.lexsort((row, -value, window))
            window, value, row = window[order], value[order], row[order]
            place = np.arange(len(window)) - np.searchsorted(window, window)
            best = place < keep
            window, value, row, place = window[best], value[best], row[best], place[best]
            full = place == keep - 1
            g.low[window[full]] = value[full]
        a = g.owner[window]
        columns = [g.run[a], g.block[a], g.place[a], g.tag[window], g.ids[a], g.positive[window], g.positive_score[window], row, value]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    keys = ["group", "dims", "run"]
    return chosen.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(score, FOUND)


def _opened(positives: DataFrame, low: int, high: int) -> DataFrame:
    """Per block of anchors the windows of its positives: ``low`` to ``high`` hundredths of their scores."""

    def pack(rows: pa.Table) -> pa.Table:
        place, tag, ids, score = (np.asarray(rows[c]) for c in ("place", "rank", "id", "score"))
        lows, highs = -((-low * score) // 100), (high * score) // 100
        used = np.flatnonzero(lows <= highs)
        parts = [place.astype(np.int32), lows, highs, tag.astype(np.int32), ids, score]
        columns = [pa.array([p[used].tobytes()], pa.binary()) for p in parts]
        names = [f.split()[0] for f in OPEN.split(", ")]
        return pa.table([rows["a_run"][:1], rows["a_block"][:1], *columns], names=["a_run", "a_block", *names])

    return positives.select("a_run", "a_block", "place", "rank", "id", "score").groupBy("a_run", "a_block").applyInArrow(pack, f"a_run int, a_block int, {OPEN}")


def _best(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """Adds ``rank``; Spark cuts each window to ``keep`` rows before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    rows: DataFrame,
    anchor: Column,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors.

    A positive is one of the first ``positives`` other rows of the anchor's label; its negatives are the first
    ``negatives`` rows of other labels whose score lies between ``low`` and ``high`` hundredths of its own.
    """
    spark = rows.sparkSession
    importable(spark)
    scratch = Scratch(spark, "negatives")
    stored = scratch.store
    taken = rows.select(
        F.col(row_id).cast("long").alias("id"),
        (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = taken.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite)
    spread = _spread(taken)
    most = max([max(abs(low_).max(), abs(high_).max()) for _, low_, high_ in spread.values() if len(low_)], default=0.0)
    dims = max(spread, default=0)
    if most * most * max(dims, 1) >= 2.0**56:
        raise ValueError("scores of these vectors can pass 56 bits; scale them down")
    kind = np.dtype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)
    exact = np.float64 if most * most * max(dims, 1) < 2**53 else np.int64
    n_rows = sum(n for n, _, _ in spread.values())
    keyed = _keyed(taken, spread, kind).repartitionByRange(max(1, -(-n_rows // RUN_ROWS)), "dims", "key", "id", "label")
    ordered = keyed.sortWithinPartitions("dims", "key", "id", "label", "vector", "anchor")
    blocks = stored(_blocked(ordered, kind, exact, positives), "blocks")
    zones = blocks.select("run", "block", "dims", "kinds", "low", "high")
    anchors = stored(_anchors(blocks, kind), "anchors")
    needed = stored(_needed(zones, anchors, kind, exact, True), "first-reads")
    found = _search(blocks, anchors, needed, kind, exact, True, positives)
    best = stored(_best(found, ["a_run", "a_block", "place"], positives), "positives")
    names = [f.split()[0] for f in ANCHORS.split(", ")]
    second = stored(anchors.select(*names).join(_opened(best, low, high), ["a_run", "a_block"]), "windows")
    needed = stored(_needed(zones, second, kind, exact, False), "second-reads")
    found = _search(blocks, second, needed, kind, exact, False, negatives)
    ranked = _best(found, ["a_run", "a_block", "place", "tag"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
    answer = stored(ranked, "answer")
    scratch.free(answer)
    return answer
