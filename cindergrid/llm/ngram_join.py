"""N-gram Jaccard join: prefix-tree join of globally ordered shingle sets.

1. Every text becomes its set of distinct word shingles; equal sets are one set (``set_id``).
2. Shingles are counted over all sets: blocks of (shingle, set) go to buckets by shingle. A shingle of
   one set can't be shared, so only the others travel on, back to their sets. With sets ordered by rising
   count, a set's prefix is so short that two similar sets must share one of its shingles.
3. Sets that share a prefix shingle are tied to the least of them, and the connected ties are families:
   similar sets are always in one family.
4. A family's sets are stored in a trie, most frequent shingle first. A probe walks the trie with the
   overlap so far, shared by all sets below a node, and leaves a subtree once the shingles that remain
   cannot reach the overlap that the smallest set below needs, or once the overlap is enough for the largest
   set below, which links all of them. Every link is found, exactly and once, and counted for both sets;
   only links that join two components are written.
5. Components over the links; every document gets the least document of its component, and its number of links,
   sets counted by their rows.

Skew. A shingle of a hundredth of all sets is heavy: heavy ones are found by local counts, ordered last,
and kept out of the buckets (this order decides speed, never results). Large families are cut into
blocks of bounded size; blocks are joined with themselves first, then a set meets each other block that has
one of its prefix shingles in a set of similar size. Nothing is dropped, capped or sampled.

Defined results: a NULL, empty or blank text has no shingles, size 0 and is its own component; NULL ids
take part, but never name a component unless all of its ids are NULL; repeated rows share one set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindergrid.llm.blocks import planes, unplaned
from cindergrid.llm.components import components
from cindergrid.llm.scratch import Scratch
from cindergrid.llm.shingles import set_id, shingle_sets
from cindergrid.llm.words import importable, raw_bytes, slices
from cindergrid.session import work_folder

#: Similar: 9 * overlap >= 4 * (size + size), which is Jaccard 0.8.
NUMERATOR, DENOMINATOR = 4, 9
#: Text of one block of documents in a task.
PIECE = 2 << 20
#: Shingles of a bucket, sets of a family's block, shingles of a family's block.
BUCKET_ROWS = 1_000_000
BLOCK_SETS = 1_000
BLOCK_TOKENS = 2_000_000
#: A shingle of more than this share of all sets is heavy; no more than so many are told apart.
HEAVY_SHARE = 0.01
HEAVY_MOST = 200_000


def prefix_length(n: int | np.ndarray) -> int | np.ndarray:
    """Shingles of a set of n of which a similar set must have one: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


def shingled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``set_id`` (NULL for an empty set)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                sets = shingle_sets(raw_bytes(piece.column(1)))
                ids = [set_id(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64())],
                    names=["doc_id", "n_shingles", "set_id"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, set_id long")


def heavy_shingles(docs: DataFrame, n_sets: int, text: str = "text") -> np.ndarray:
    """Sorted shingles found in more than ``HEAVY_SHARE`` of all sets, as far as local counts show."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                sets = {set_id(s): s for s in shingle_sets(raw_bytes(piece.column(0))) if len(s)}
                if sets:
                    found, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
                    often = counts >= max(2, len(sets) * HEAVY_SHARE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[often].view(np.int64)), pa.array(counts[often], pa.int64())], names=["shingle", "n"]
                    )

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "shingle long, n long")
    most = counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") > max(100, n_sets * HEAVY_SHARE))
    rows = most.orderBy(F.col("n").desc(), "shingle").limit(HEAVY_MOST).select("shingle").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _blocks(docs: DataFrame, text: str, heavy, n_buckets: int) -> DataFrame:
    """(bucket, shingles, owners, sets, sizes): sorted shingles, each with the place of its set in a table of sets.

    Heavy shingles go to bucket -1 - k, by set.
    """

    def packed(bucket: int, h: np.ndarray, owner: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple:
        table, place = np.unique(owner, return_inverse=True)
        return bucket, planes(h), planes(place.astype(np.uint32)), planes(ids[table]), planes(sizes[table])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                sets = {set_id(s): s for s in shingle_sets(raw_bytes(piece.column(0))) if len(s)}
                if not sets:
                    continue
                ids = np.array(list(sets), np.int64)
                sizes = np.array([len(s) for s in sets.values()], np.uint32)
                h = np.concatenate(list(sets.values()))
                owner = np.repeat(np.arange(len(ids)), sizes)
                is_heavy = np.zeros(len(h), bool)
                if len(heavy.value):
                    at = np.minimum(np.searchsorted(heavy.value, h), len(heavy.value) - 1)
                    is_heavy = heavy.value[at] == h
                out = []
                if is_heavy.any():
                    to = ids[owner[is_heavy]].view(np.uint64) % np.uint64(n_buckets)
                    hh, ho = h[is_heavy], owner[is_heavy]
                    for b in np.unique(to).tolist():
                        mine = to == b
                        out.append(packed(-1 - b, hh[mine], ho[mine], ids, sizes))
                h, owner = h[~is_heavy], owner[~is_heavy]
                bucket = (h >> np.uint64(32)) % np.uint64(n_buckets)
                order = np.lexsort((h, bucket))
                h, owner, bucket = h[order], owner[order], bucket[order]
                edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(h) else [0]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    out.append(packed(int(bucket[a]), h[a:b], owner[a:b], ids, sizes))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)

    return docs.select(F.col(text).alias("text")).mapInArrow(run, BLOCK)


NAMES = ["bucket", "shingles", "owners", "sets", "sizes"]
BLOCK = "bucket long, shingles binary, owners binary, sets binary, sizes binary"


def _unpacked(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, sets and sizes of all rows of a block, side by side."""
    h, ids, sizes = [], [], []
    for i in range(block.num_rows):
        place = unplaned(block["owners"][i].as_py(), np.uint32)
        h.append(unplaned(block["shingles"][i].as_py(), np.uint64))
        ids.append(unplaned(block["sets"][i].as_py(), np.int64)[place])
        sizes.append(unplaned(block["sizes"][i].as_py(), np.uint32)[place])
    return np.concatenate(h), np.concatenate(ids), np.concatenate(sizes)


def _shared(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """Shingles of two sets or more, by bucket of the set: (bucket, shingles, counts, sets, sizes)."""

    def count(block: pa.Table) -> pa.Table:
        bucket = block["bucket"][0].as_py()
        h, ids, sizes = _unpacked(block)
        order = np.lexsort((ids, h))
        h, ids, sizes = h[order], ids[order], sizes[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])])
        h, ids, sizes = h[new], ids[new], sizes[new]
        if bucket < 0:  # heavy shingles: after all others
            n = np.full(len(h), 0xFFFFFFFF, np.uint32)
        else:
            runs = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
            n = np.repeat(np.diff(runs), np.diff(runs)).astype(np.uint32)
            many = n > 1
            h, ids, sizes, n = h[many], ids[many], sizes[many], n[many]
        to = ids.view(np.uint64) % np.uint64(n_buckets)
        order = np.lexsort((ids, to))
        h, ids, sizes, n, to = h[order], ids[order], sizes[order], n[order], to[order]
        edges = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(h) else [0]
        rows = [
            (int(to[a]), planes(h[a:b]), planes(n[a:b]), planes(ids[a:b]), planes(sizes[a:b]))
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), *[pa.binary()] * 4]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "shingles", "counts", "sets", "sizes"])

    return blocks.groupBy("bucket").applyInArrow(count, "bucket long, shingles binary, counts binary, sets binary, sizes binary")


def _ordered(shared: DataFrame) -> DataFrame:
    """(set_id, n, prefix, tokens) of the sets whose prefix has a shared shingle; tokens by rising count."""

    def gather(block: pa.Table) -> pa.Table:
        parts = [
            [unplaned(block[c][i].as_py(), kind) for i in range(block.num_rows)]
            for c, kind in (("shingles", np.uint64), ("counts", np.uint32), ("sets", np.int64), ("sizes", np.uint32))
        ]
        h, n, ids, sizes = (np.concatenate(p) for p in parts)
        order = np.lexsort((h, n, ids))
        h, ids, sizes = h[order], ids[order], sizes[order]
        edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
        rows = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            size = int(sizes[a])
            # The shingles that no other set has come first and use up the prefix.
            prefix = int(prefix_length(size)) - (size - (b - a))
            if prefix > 0:
                rows.append((int(ids[a]), size, h[a : a + prefix].view(np.int64).tolist(), h[a:b].tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["set_id", "n", "prefix", "tokens"])

    return shared.groupBy("bucket").applyInArrow(gather, "set_id long, n long, prefix array<long>, tokens binary")


class _Node:
    __slots__ = ("run", "children", "sets", "rest", "least", "most", "one", "weight", "hits")

    def __init__(self, run: np.ndarray):
        self.run = run  # shingles on the way into this node
        self.children: dict[int, _Node] = {}
        self.sets: list[int] = []  # sets that end here
        self.rest = 0  # most shingles below
        self.least, self.most = 1 << 62, 0  # sizes of the sets below
        self.one: int | None = None  # a set below, if all below are known to be connected
        self.weight = 0  # rows of the sets below
        self.hits = 0  # rows linked to every set below


class PrefixTree:
    """A trie of ordered shingle sets with union-find over its sets and the links of each set.

    ``weights`` are the rows that share a set; ``links`` are only those that joined two components.
    """

    def __init__(
        self, sizes: np.ndarray, ranks: list[np.ndarray], n_ranks: int, parents: np.ndarray | None = None, weights: np.ndarray | None = None
    ):
        self.sizes, self.ranks = sizes.tolist(), ranks
        self.parents = list(range(len(sizes))) if parents is None else parents.tolist()
        self.weights = [1] * len(sizes) if weights is None else weights.tolist()
        self.found = [0] * len(sizes)
        self.has = np.zeros(n_ranks, bool)
        self.top = _Node(np.zeros(0, np.int32))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.parents[x] != x:
            self.parents[x] = self.parents[self.parents[x]]
            x = self.parents[x]
        return x

    def add(self, x: int) -> None:
        node, left = self.top, self.ranks[x]
        mine = self.root(x)
        while True:
            fresh = node.most == 0
            node.rest = max(node.rest, len(left))
            node.least, node.most = min(node.least, self.sizes[x]), max(node.most, self.sizes[x])
            node.weight += self.weights[x]
            self.found[x] -= node.hits  # these came before
            if fresh:
                node.one = x
            elif node.one is not None and self.root(node.one) != mine:
                node.one = None
            if not len(left):
                node.sets.append(x)
                return
            child = node.children.get(int(left[0]))
            if child is None:
                child = node.children[int(left[0])] = _Node(left)
                child.least = child.most = self.sizes[x]
                child.sets, child.one, child.weight = [x], x, self.weights[x]
                return
            n = min(len(left), len(child.run))
            differ = np.flatnonzero(left[:n] != child.run[:n])
            same = int(differ[0]) if len(differ) else n
            if same < len(child.run):  # cut the way into two
                upper = _Node(child.run[:same])
                upper.rest = child.rest + len(child.run) - same
                upper.least, upper.most, upper.one, upper.weight = child.least, child.most, child.one, child.weight
                child.run = child.run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(left[0])] = upper
                child = upper
            node, left = child, left[same:]

    def _connect(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.links.append((x, y))
            self.parents[a] = b

    def _connect_all(self, x: int, node: _Node) -> None:
        """Connects x to every set below a node."""
        stack = [node]
        while stack:
            below = stack.pop()
            if below.one is not None:
                self._connect(x, below.one)
                continue
            for y in below.sets:
                self._connect(x, y)
            stack.extend(below.children.values())
            below.one = x

    def probe(self, x: int) -> None:
        """Counts every link of x to a set of the trie, on both sides, and connects x to their components."""
        mine, size, weight = self.ranks[x], self.sizes[x], self.weights[x]
        self.has[mine] = True
        stack: list[tuple[_Node, int]] = [(self.top, 0)]
        while stack:
            node, overlap = stack.pop()
            if not node.most or 5 * node.most < 4 * size or 4 * node.least > 5 * size:
                continue
            if len(node.run):
                overlap += int(np.count_nonzero(self.has[node.run]))
                behind = len(mine) - int(np.searchsorted(mine, node.run[-1], side="right"))
            else:
                behind = len(mine)
            needed = NUMERATOR * (size + max(node.least, (4 * size + 4) // 5))
            if DENOMINATOR * (overlap + min(behind, node.rest)) < needed:
                continue
            if DENOMINATOR * overlap >= NUMERATOR * (size + node.most):  # similar to all below, whatever follows
                self.found[x] += node.weight
                node.hits += weight
                self._connect_all(x, node)
                continue
            for y in node.sets:
                if DENOMINATOR * overlap >= NUMERATOR * (size + self.sizes[y]):
                    self.found[x] += self.weights[y]
                    self.found[y] += weight
                    self._connect(x, y)
            stack.extend((child, overlap) for child in node.children.values())
        self.has[mine] = False

    def n_links(self) -> list[int]:
        """Per set the rows of other sets that the probes found similar to it."""
        out = list(self.found)
        stack = [(self.top, 0)]
        while stack:
            node, hits = stack.pop()
            hits += node.hits
            for y in node.sets:
                out[y] += hits
            stack.extend((child, hits) for child in node.children.values())
        return out


def _ranked(block: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], int]:
    """Sets, sizes and shingles as ranks, the most frequent of the block first."""
    ids, sizes = np.array(block["set_id"].to_pylist(), np.int64), np.array(block["n"].to_pylist(), np.int64)
    sets = [np.frombuffer(t, np.uint64) for t in block["tokens"].to_pylist()]
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(tokens), dtype=np.int32)
    edges = np.cumsum([0, *map(len, sets)])
    ranked = rank[inverse]
    return ids, sizes, [np.sort(ranked[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], len(tokens)


def _within(block: pa.Table) -> pa.Table:
    """Every set ``a`` of one block with the one ``b`` that stands for what it is connected to there, and its links."""
    ids, sizes, ranks, n = _ranked(block)
    tree = PrefixTree(sizes, ranks, n, weights=np.array(block["copies"].to_pylist(), np.int64))
    for x in np.argsort(sizes, kind="stable").tolist():
        tree.probe(x)
        tree.add(x)
    roots = [int(ids[tree.root(x)]) for x in range(len(ids))]
    columns = [pa.array(ids, pa.int64()), pa.array(roots, pa.int64()), pa.array(tree.n_links(), pa.int64())]
    return pa.table(columns, names=["a", "b", "n_links"])


def _across(block: pa.Table) -> pa.Table:
    """Links between two blocks of a family that connect what ``known`` does not; (a, a, n_links) counts all of them."""
    ids, sizes, ranks, n = _ranked(block)
    known = np.array(block["known"].to_pylist(), np.int64)
    _, first, inverse = np.unique(known, return_index=True, return_inverse=True)
    tree = PrefixTree(sizes, ranks, n, first[inverse], np.array(block["copies"].to_pylist(), np.int64))
    low = np.array(block["low"].to_pylist(), bool)
    for x in np.flatnonzero(low).tolist():
        tree.add(x)
    for x in np.flatnonzero(~low).tolist():
        tree.probe(x)
    rows = [(int(ids[x]), int(ids[y]), 0) for x, y in tree.links]
    rows += [(int(ids[x]), int(ids[x]), k) for x, k in enumerate(tree.n_links()) if k]
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b", "n_links"])


def _families(ordered: DataFrame) -> DataFrame:
    """``set_id, family``: sets connected by shared prefix shingles."""
    posted = ordered.select("set_id", F.explode("prefix").alias("shingle"))
    least = posted.groupBy("shingle").agg(F.min("set_id").alias("first"), F.max("set_id").alias("last"))
    ties = posted.join(least.where("first < last").select("shingle", "first"), "shingle").where("set_id <> first")
    found = components(ties.select(F.col("set_id").alias("a"), F.col("first").alias("b")).distinct(), "ngram-families")
    return found.select(F.col("node").alias("set_id"), F.col("component").alias("family"))


def similar_sets(docs: DataFrame, copies: DataFrame, n_sets: int, n_shingles: int, text: str = "text") -> DataFrame:
    """(a, b, n_links): pairs that connect exactly the sets which similarity connects, and links of ``a``.

    Rows with a = b connect nothing. ``n_links`` adds up, over the rows of a set, to the rows of all
    other sets similar to it; ``copies`` (set_id, copies) says how many rows the sets of several rows have.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    stored = scratch.store
    n_buckets = max(1, -(-n_shingles // BUCKET_ROWS))
    heavy = spark.sparkContext.broadcast(heavy_shingles(docs, n_sets, text))
    ordered = stored(_ordered(_shared(_blocks(docs, text, heavy, n_buckets), n_buckets)), "sets")
    families = _families(ordered)
    sizes = families.join(ordered.select("set_id", (F.octet_length("tokens") / 8).alias("t")), "set_id").groupBy("family").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("t") / BLOCK_TOKENS)).cast("int").alias("blocks")
    )
    placed = families.join(sizes, "family").select(
        "set_id", "family", "blocks", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("block")
    )
    placed = placed.join(copies, "set_id", "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
    members = stored(ordered.select("set_id", "n", "tokens").join(placed, "set_id"), "members")
    pair = "a long, b long, n_links long"
    near = stored(members.select("family", "block", "set_id", "n", "tokens", "copies").groupBy("family", "block").applyInArrow(_within, pair), "links")
    large = members.where("blocks > 1")
    if large.isEmpty():
        scratch.free(near)
        return near
    paired = _exchanged(ordered, members).join(near.select(F.col("a").alias("set_id"), F.col("b").alias("known")), "set_id")
    far = paired.select("family", "i", "j", "set_id", "n", "tokens", "copies", "known", "low").groupBy("family", "i", "j").applyInArrow(_across, pair)
    further = stored(far, "links")
    scratch.free(near, further)
    return near.unionByName(further)


def _exchanged(ordered: DataFrame, members: DataFrame) -> DataFrame:
    """Sets of families of several blocks, once for every other block that may hold a set similar to it.

    Two similar sets share a prefix shingle and have similar sizes, so a set meets those blocks only in which one of its
    prefix shingles is in the prefix of a set of such a size. A family that hangs together by a few shingles here and
    there exchanges little, however large it is.
    """
    large = members.where("blocks > 1").select("set_id", "family", "block")
    posted = ordered.select("set_id", "n", F.explode("prefix").alias("shingle")).join(large, "set_id")
    there = posted.groupBy("shingle", F.col("block").alias("other")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    fits = (F.col("other") != F.col("block")) & (5 * F.col("n") >= 4 * F.col("least")) & (4 * F.col("n") <= 5 * F.col("most"))
    meets = posted.join(there, "shingle").where(fits).select("set_id", "other").distinct()
    paired = members.join(meets, "set_id")
    return paired.withColumns(
        {"low": F.col("block") < F.col("other"), "i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id`` (the least doc_id connected by similarity), ``set_id`` and ``n_links``.

    ``n_links`` is the number of other rows similar to this one, rows of the same set included.
    """
    spark = docs.sparkSession
    importable(spark)
    path = work_folder(spark, "ngram-shingled")
    shingled(docs, doc_id, text).write.parquet(path)
    rows = spark.read.parquet(path)
    sets = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    known = sets.agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")).first()
    links = similar_sets(docs, sets.where("copies > 1").select("set_id", "copies"), known["sets"], known["shingles"] or 0, text)
    found = components(links, "ngram-components").select(F.col("node").alias("set_id"), "component")
    n_links = links.groupBy(F.col("a").alias("set_id")).agg(F.sum("n_links").alias("n_links"))
    named = sets.join(found, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    counted = named.join(n_links.where("n_links > 0"), "set_id", "left").select(
        "set_id", "component", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    answer = counted.join(least, "component").select("set_id", "component_id", "n_links")
    out = rows.join(answer, "set_id", "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "set_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
