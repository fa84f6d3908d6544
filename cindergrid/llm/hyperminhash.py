"""Near-duplicates by HyperMinHash: compressed registers, bands of them, corrected estimates, full sets.

1. Every text becomes its set of distinct word shingles; equal sets are one set, named by 128 bits.
2. A set's sketch has ``REGISTERS`` buckets. Each shingle falls into a bucket, and a bucket keeps its smallest hash
   as leading zeros and mantissa: 6 and 10 bits. So that small sets fill their buckets, a shingle enters ``copies``
   times with different hashes, which leaves the Jaccard similarity as it is; ``copies`` goes by the size of the set,
   and a set near a change of ``copies`` has both sketches, so two similar sets always have one in common.
3. ``BANDS`` draws of ``BAND`` registers are the keys under which sets meet. Sets of a key are tied in stars, in buckets
   of keys; a key of many sets in one piece of text is tied there already and sends one of them on.
4. A tie is dropped if the sizes exclude it or its estimate, corrected for chance collisions of registers, lies
   ``SIGMAS`` standard deviations below the threshold; the rest is verified on the full sets.
   Each set first tries its strongest tie; then each two components that ties lead across try the strongest of these.
5. A key whose stars hold a tie that failed or was not tried may still hold a link between two of its sets. Sets are
   therefore gathered at the components that they are tied to, and where these are several, those outside the largest
   one are held against all others there, in tasks of bounded size.
6. Components over verified links; each document gets the least doc_id of its component.

A link at the threshold itself shares no key with probability under 1e-8, and less the more similar the sets are.
Sets of up to three shingles can only link to equal ones.

Defined results: a NULL, empty or blank text has no shingles, size 0, is its own component and kept; NULL ids
take part but name a component only if all of its ids are NULL; repeated rows share one set, and are all kept or
all not; an empty table gives no rows. Other columns are not read, whatever their names. A text is one row of a
task, as long as it may be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindergrid.llm.bitmaps import holds, marked
from cindergrid.llm.blocks import planes, unplaned
from cindergrid.llm.components import components
from cindergrid.llm.scratch import Scratch
from cindergrid.llm.shingles import mixed, shingle_sets
from cindergrid.llm.words import importable, raw_bytes, slices
from cindergrid.session import work_folder

WORDS = 2
#: Similar: 100 * overlap >= PERCENT * union.
PERCENT = 80
#: Buckets (a power of two), bits of the mantissa, hashes per bucket at least.
BUCKET_BITS, MANTISSA, FILL = 9, 10, 4
REGISTERS = 1 << BUCKET_BITS
BANDS, BAND = 128, 8
SIGMAS = 6.5
#: Two minima of the same rate agree in lz and mantissa with about this share of 2 ** -MANTISSA, times 4.
CHANCE = 1 / (2 * np.log(2))
#: Text of a piece, pieces whose sets are tied before they are sent, keys of a bucket.
PIECE, PIECES, BUCKET_KEYS = 2 << 20, 8, 1_000_000
#: Sets of a key in one piece that it sends on; with more it sends the first one only.
SENT = 32
#: Sets that ask, and sets that answer, in a task of step 5.
HOME_SETS = 2000

_draw = np.random.default_rng(12)
_PICKS = np.stack([_draw.permutation(REGISTERS)[:BAND] for _ in range(BANDS)])
_FACTORS = _draw.integers(1, 1 << 63, (BANDS, BAND), dtype=np.uint64) | np.uint64(1)
_SALT = _draw.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def name_of(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def copies(n: int) -> int:
    """How often each shingle of a set of n enters the sketch."""
    return 1 << max(0, (FILL * REGISTERS - 1) // n).bit_length() if n < FILL * REGISTERS else 1


def grades(n: int) -> list[int]:
    """The numbers of copies a set of n needs: its own, and that of the smallest set similar to it."""
    return sorted({copies(n), copies(-(-n * PERCENT // 100))})


def registers(sets: list[np.ndarray], times: int) -> np.ndarray:
    """(sets, REGISTERS): leading zeros and mantissa of the smallest hash of each bucket; all ones if it is empty."""
    least = np.full(len(sets) * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    h = np.concatenate(sets)
    step = max(1, (1 << 22) // times)
    salts = np.arange(times, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for a in range(0, len(h), step):
        v = mixed(h[a : a + step, None] + salts)
        bucket = (v >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + owner[a : a + step, None] * REGISTERS
        np.minimum.at(least, bucket.ravel(), (v << np.uint64(BUCKET_BITS)).ravel())
    mantissa, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, (1 << 16 - MANTISSA) - 1)
    rest = np.clip(np.floor((2 * mantissa - 1) * (1 << MANTISSA)), 0, (1 << MANTISSA) - 1).astype(np.int64)
    found = ((zeros << MANTISSA) | rest).astype(np.uint16)
    found[least == np.iinfo(np.uint64).max] = 0xFFFF
    return found.reshape(len(sets), REGISTERS)


def band_keys(found: np.ndarray, times: int) -> np.ndarray:
    """(sets, BANDS): what sets must have in common to meet."""
    picked = found[:, _PICKS].astype(np.uint64) * _FACTORS
    return mixed(picked.sum(2, dtype=np.uint64) + _SALT + np.uint64(times))


def estimate(one: np.ndarray, other: np.ndarray, n: int, m: int) -> float:
    """Jaccard similarity of sets of n and m shingles, without the registers that agree by chance."""
    used = (one != 0xFFFF) | (other != 0xFFFF)
    chance = CHANCE / (1 << MANTISSA) * n * m / (n + m) ** 2
    share = np.count_nonzero((one == other) & used) / max(1, np.count_nonzero(used))
    return (share - chance) / (1 - chance)


def estimates(one: np.ndarray, others: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
    """The same for one set and many others."""
    used = ((one != 0xFFFF) | (others != 0xFFFF)).sum(1)
    chance = CHANCE / (1 << MANTISSA) * n * m / (n + m) ** 2
    share = ((one == others) & (one != 0xFFFF)).sum(1) / np.maximum(1, used)
    return (share - chance) / (1 - chance)


def overlap_reaches(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two full sets are similar."""
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    both = int(np.count_nonzero(other[at] == one))
    return 100 * both >= PERCENT * (len(one) + len(other) - both)


def lowest_estimate(used: int = REGISTERS) -> float:
    t = PERCENT / 100
    return t - SIGMAS * np.sqrt(t * (1 - t) / used)


def _sketched(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per number of copies: that number, the sets (by place) that need it, and their registers."""
    need: dict[int, list[int]] = {}
    for k, s in enumerate(sets):
        for times in grades(len(s)):
            need.setdefault(times, []).append(k)
    for times, at in sorted(need.items()):
        yield times, np.array(at), registers([sets[k] for k in at], times)


def shingled(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``name`` (NULL for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                sets = shingle_sets(raw_bytes(piece.column(1)), WORDS)
                names = [name_of(s) if len(s) else None for s in sets]
                columns = [piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "name"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, name binary")


PACKED = "bucket long, keys binary, owners binary, names binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "keys", "owners", "names"])


def _slots(keys: np.ndarray) -> np.ndarray:
    """(keys, 2): one of 128 bits for each key, so that pairs which share a key share a bit."""
    bit = np.uint64(1) << (keys & np.uint64(63))
    upper = keys >> np.uint64(6) & np.uint64(1) != 0
    return np.stack([np.where(upper, np.uint64(0), bit), np.where(upper, bit, np.uint64(0))], 1)


def _stars(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, set) pairs, sets by rank: the first of each key (places), and for all others their set and that first one.

    Each such pair once, with the number of its keys and their slots.
    """
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    hub = owner[first][np.cumsum(fresh) - 1]
    ray = owner != hub
    pairs, at, counts = np.unique(np.stack([owner[ray], hub[ray]], 1), axis=0, return_inverse=True, return_counts=True)
    slots = np.zeros((len(pairs), 2), np.uint64)
    np.bitwise_or.at(slots, at.ravel(), _slots(key[ray]))
    return order[first], pairs, counts, slots


def _met(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Keys with one set for each piece of text (bucket 0 and up), and the ties made in pieces (below 0)."""

    def flush(seen: list[tuple[bytes, np.ndarray]]) -> pa.RecordBatch:
        names = np.frombuffer(b"".join(n for n, _ in seen), "V16")
        rank = np.argsort(np.argsort(np.array([n for n, _ in seen], object), kind="stable"), kind="stable")
        by_rank = np.argsort(rank)
        keys = np.concatenate([k for _, k in seen])
        owner = np.repeat(rank, [len(k) for _, k in seen])
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        runs = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        many = np.repeat(np.diff(runs) > SENT, np.diff(runs))
        first, pairs, counts, slots = _stars(keys[many], owner[many])
        key, owner = (np.concatenate([x[~many], x[many][first]]) for x in (keys, owner))
        bucket = ((key >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
        rows = []
        order = np.lexsort((key, bucket))
        edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            mine = order[a:b]
            table, place = np.unique(owner[mine], return_inverse=True)
            rows.append((int(bucket[mine[0]]), planes(key[mine]), planes(place.astype(np.uint32)), names[by_rank[table]].tobytes()))
        to = -1 - pairs[:, 0] % n_buckets
        for b in np.unique(to).tolist():
            mine = to == b
            table, place = np.unique(pairs[mine], return_inverse=True)
            about = np.concatenate([counts[mine, None].astype(np.uint64), slots[mine]], 1)
            rows.append((b, planes(about.ravel()), planes(place.ravel().astype(np.uint32)), names[by_rank[table]].tobytes()))
        return _packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        waiting: list[tuple[bytes, np.ndarray]] = []
        pieces = 0
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                fresh = {}
                for s in shingle_sets(raw_bytes(piece.column(0)), WORDS):
                    if len(s) > 3 and (name := name_of(s)) not in known:
                        known.add(name)
                        fresh[name] = s
                sets, keys = list(fresh.values()), [[] for _ in fresh]
                for times, at, found in _sketched(sets):
                    for k, row in zip(at.tolist(), band_keys(found, times), strict=True):
                        keys[k].append(row)
                waiting += [(n, np.concatenate(k)) for n, k in zip(fresh, keys, strict=True)]
                pieces += 1
                if waiting and pieces % PIECES == 0:
                    yield flush(waiting)
                    waiting = []
        if waiting:
            yield flush(waiting)

    return docs.select("text").mapInArrow(run, PACKED)


def _ties(met: DataFrame) -> DataFrame:
    """(a, b, bands, near, low, high): stars over the sets of each key, by name; ``near`` tells a tie that some piece made.

    ``low`` and ``high`` are the slots of the keys that tie them.
    """

    def tie(rows: pa.Table) -> pa.Table:
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        ties: dict[tuple[bytes, bytes], tuple[int, int, int]] = {}
        tables = [np.frombuffer(r, "V16") for r in rows["names"].to_pylist()]
        owners = [unplaned(r, np.uint32) for r in rows["owners"].to_pylist()]
        if rows["bucket"][0].as_py() < 0:
            for table, owner, n in zip(tables, owners, rows["keys"].to_pylist(), strict=True):
                for (x, y), (k, low, high) in zip(owner.reshape(-1, 2).tolist(), unplaned(n, np.int64).reshape(-1, 3).tolist(), strict=True):
                    pair = table[x].tobytes(), table[y].tobytes()
                    had = ties.get(pair, (0, 0, 0))
                    ties[pair] = had[0] + k, had[1] | low, had[2] | high
        else:
            raw = np.concatenate(tables)
            words = raw.view(">u8").reshape(-1, 2)
            order = np.lexsort((words[:, 1], words[:, 0]))
            new = np.concatenate([[True], (words[order][1:] != words[order][:-1]).any(1)])
            rank = np.empty(len(raw), np.int64)
            rank[order] = np.cumsum(new) - 1
            shown = raw[order][new]
            before = np.cumsum([0, *map(len, tables)])
            owner = rank[np.concatenate([o + b for o, b in zip(owners, before, strict=False)])]
            key = np.concatenate([unplaned(k, np.uint64) for k in rows["keys"].to_pylist()])
            _, pairs, counts, slots = _stars(key, owner)
            for (x, y), k, (low, high) in zip(pairs.tolist(), counts.tolist(), slots.view(np.int64).tolist(), strict=True):
                ties[shown[x].tobytes(), shown[y].tobytes()] = k, low, high
        about = list(zip(*ties.values(), strict=True)) or [[]] * 3
        columns = [[a for a, _ in ties], [b for _, b in ties], about[0], [rows["bucket"][0].as_py() < 0] * len(ties), *about[1:]]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "bands", "near", "low", "high"])

    each = met.groupBy("bucket").applyInArrow(tie, "a binary, b binary, bands long, near boolean, low long, high long")
    totals = [F.sum("bands").alias("bands"), F.max("near").alias("near"), F.bit_or("low").alias("low"), F.bit_or("high").alias("high")]
    return each.groupBy("a", "b").agg(*totals)


SKETCH = "name binary, n long, times array<int>, registers array<binary>, hashes binary"


def _tied_sets(docs: DataFrame, bitmap) -> DataFrame:
    """Sketches and full sets of the sets that have a tie (by the bitmap: a few others too), once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                named = [(name_of(s), s) for s in shingle_sets(raw_bytes(piece.column(0)), WORDS) if len(s) > 3]
                if not named:
                    continue
                tied = holds(bitmap.value, np.array([_key(n) for n, _ in named], np.int64))
                fresh = {n: s for (n, s), t in zip(named, tied.tolist(), strict=True) if t and n not in known}
                known |= fresh.keys()
                sets = list(fresh.values())
                times, found = [[] for _ in sets], [[] for _ in sets]
                for grade, at, rows in _sketched(sets):
                    for k, row in zip(at.tolist(), rows, strict=True):
                        times[k].append(grade)
                        found[k].append(row.tobytes())
                columns = [list(fresh), [len(s) for s in sets], times, found, [s.tobytes() for s in sets]]
                kinds = [pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["name", "n", "times", "registers", "hashes"])

    return docs.select("text").mapInArrow(run, SKETCH)


def _key(name: bytes) -> int:
    return int.from_bytes(name[:8], "big", signed=True)


def _common(row: dict) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of copies that both sets of a pair have, and both registers."""
    times = max(set(row["times_a"]) & set(row["times_b"]))
    one, other = (row[f"registers_{x}"][row[f"times_{x}"].index(times)] for x in "ab")
    return times, np.frombuffer(one, np.uint16), np.frombuffer(other, np.uint16)


def _paired(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with these columns of both sets."""
    for x in "ab":
        own = sets.select(F.col("name").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])
        pairs = pairs.join(own, x)
    return pairs


def _similar(pairs: DataFrame, sets: DataFrame, stored) -> DataFrame:
    """(a, b, linked) of the pairs: by sizes, then by corrected estimates, then by the full sets."""
    lowest = lowest_estimate()

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for row in batch.to_pylist():
                n, m = sorted((row["n_a"], row["n_b"]))
                near.append(100 * n >= PERCENT * m and estimate(*_common(row)[1:], n, m) >= lowest)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], names=["a", "b", "near"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("hashes_a"), batch.column("hashes_b"), strict=True):
                linked.append(overlap_reaches(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    out = "a binary, b binary"
    asked = _paired(pairs.select("a", "b"), sets, ["n", "times", "registers"])
    near = stored(asked.mapInArrow(estimated, f"{out}, near boolean"), "estimates")
    full = _paired(near.where("near").select("a", "b"), sets, ["hashes"]).mapInArrow(verified, f"{out}, linked boolean")
    far = near.where("NOT near").select("a", "b", F.lit(False).alias("linked"))
    return stored(full.unionByName(far), "verified")


def _ends(ties: DataFrame) -> DataFrame:
    """(name): the sets that have a tie."""
    return ties.select(F.col("a").alias("name")).unionByName(ties.select(F.col("b").alias("name"))).distinct()


def _leads(ties: DataFrame, found: DataFrame, tried: DataFrame) -> DataFrame:
    """(a, home, low, high, bands, b): all ties of a set that lead to one component as one row, with their slots.

    ``bands`` and ``b`` are those of the strongest one that was not tried, NULL if all were.
    """
    of = found.select(F.col("node").alias("b"), F.col("component").alias("home"))
    rows = ties.join(tried.select("a", "b", F.lit(True).alias("tested")), ["a", "b"], "left").join(of, "b", "left")
    rows = rows.withColumns({"home": F.coalesce("home", "b"), "best": F.when(F.col("tested").isNull(), F.struct("bands", "b"))})
    led = rows.groupBy("a", "home").agg(F.bit_or("low").alias("low"), F.bit_or("high").alias("high"), F.max("best").alias("best"))
    return led.select("a", "home", "low", "high", "best.bands", "best.b")


def _crossing(leads: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): of each two components that ties lead across, the strongest tie that was not tried."""
    own = found.select(F.col("node").alias("a"), F.col("component").alias("own"))
    pairs = leads.where("b IS NOT NULL").join(own, "a", "left").withColumn("own", F.coalesce("own", "a")).where("own <> home")
    best = pairs.groupBy(F.least("own", "home"), F.greatest("own", "home")).agg(F.max(F.struct("bands", "a", "b")).alias("best"))
    return best.select("best.a", "best.b")


def _meetings(ties: DataFrame, found: DataFrame, leads: DataFrame | None = None, stored=lambda rows, name: rows) -> DataFrame:
    """(home, i, j, name, component, asks, roles): the sets, gathered where each pair that shares a key meets.

    Two sets of a key are tied to its first set, directly or over the first one of a piece of text. So a set's homes
    are the components of what it is tied to, and those of what a first one that it is tied to in a piece is tied to by
    the same key: at most two for each of its keys, however many sets share them, but for chance hits of slots.
    Homes of one component are closed. In the others all sets but those of the largest component ask; each asks
    all others of the home, in parts of at most about ``HOME_SETS`` that ask and as many that answer.
    ``leads`` may be those of earlier components, which only have grown together since.
    """
    of = found.select(F.col("node").alias("name"), "component")
    own = _ends(ties).join(of, "name", "left").withColumn("component", F.coalesce("component", "name"))
    if leads is None:
        leads = _leads(ties, found, ties.select("a", "b").limit(0))
    now = of.select(F.col("name").alias("home"), F.col("component").alias("grown"))
    tied = leads.select("a", "home", "low", "high").join(now, "home", "left").withColumn("home", F.coalesce("grown", "home"))
    first = own.select("name", F.col("component").alias("home")).unionByName(tied.select(F.col("a").alias("name"), "home")).distinct()
    # From a first one of a piece on to what it is tied to by the same keys.
    onward = tied.groupBy(F.col("a").alias("to"), "home").agg(F.bit_or("low").alias("to_low"), F.bit_or("high").alias("to_high"))
    near = ties.where("near").select(F.col("a").alias("name"), F.col("b").alias("to"), "low", "high")
    over = near.join(onward, (near["to"] == onward["to"]) & ((F.col("low").bitwiseAND(F.col("to_low")) != 0) | (F.col("high").bitwiseAND(F.col("to_high")) != 0)))
    homes = first.unionByName(over.select("name", "home")).distinct()
    placed = stored(homes.join(own, "name"), "homes")
    counted = placed.groupBy("home", "component").agg(F.count(F.lit(1)).alias("n"))
    shape = counted.groupBy("home").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"))
    # Two sets alone in a home of two components have a tie that was tried, or meet in another home as well.
    shape = shape.where("all > most AND all > 2").select(
        "home", "largest", F.ceil((F.col("all") - F.col("most")) / HOME_SETS).alias("askers"), F.ceil(F.col("all") / HOME_SETS).alias("blocks")
    )
    placed = placed.join(shape, "home").withColumn("asks", F.col("component") != F.col("largest"))
    lot = lambda n: F.pmod(F.xxhash64("name"), F.col(n))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    asking = placed.where("asks").withColumns({"i": lot("askers"), "j": F.explode(every("blocks"))})
    answering = placed.withColumns({"i": F.explode(every("askers")), "j": lot("blocks")}).withColumn("asks", F.lit(False))
    both = asking.select("home", "i", "j", "name", "component", "asks").unionByName(answering.select("home", "i", "j", "name", "component", "asks"))
    return both.groupBy("home", "i", "j", "name", "component").agg(F.max("asks").alias("asks"), F.count(F.lit(1)).alias("roles"))


def _met_links(meetings: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links of each meeting that join two components, estimated first and then verified."""
    lowest = lowest_estimate()

    def meet(rows: pa.Table) -> pa.Table:
        names, parts = rows["name"].to_pylist(), rows["component"].to_pylist()
        asks = np.array(rows["asks"].to_pylist(), bool)
        # A set that asks answers too if it stands in this block, and then it has two roles.
        answers = ~asks | (np.asarray(rows["roles"]) > 1)
        sizes = np.asarray(rows["n"])
        times, found = rows["times"].to_pylist(), rows["registers"].to_pylist()
        hashes = [np.frombuffer(h, np.uint64) for h in rows["hashes"].to_pylist()]
        up: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while up.get(x, x) != x:
                x = up[x]
            return x

        out = []
        for grade in sorted({t for ts in times for t in ts}):
            mine = [k for k, ts in enumerate(times) if grade in ts]
            matrix = np.stack([np.frombuffer(found[k][times[k].index(grade)], np.uint16) for k in mine])
            mine = np.array(mine)
            ys = np.flatnonzero(answers[mine])
            for x in np.flatnonzero(asks[mine]).tolist():
                k = int(mine[x])
                other = mine[ys]
                fits = (100 * np.minimum(sizes[k], sizes[other]) >= PERCENT * np.maximum(sizes[k], sizes[other])) & (other != k)
                near = estimates(matrix[x], matrix[ys[fits]], int(sizes[k]), sizes[other[fits]]) >= lowest
                for j in other[fits][near].tolist():
                    a, b = root(parts[k]), root(parts[j])
                    if a != b and overlap_reaches(hashes[k], hashes[j]):
                        up[a] = b
                        out.append((names[k], names[j]))
        columns = list(zip(*out, strict=True)) or [[]] * 2
        return pa.table([pa.array(list(c), pa.binary()) for c in columns], names=["a", "b"])

    rows = meetings.join(sets, "name")
    return rows.groupBy("home", "i", "j").applyInArrow(meet, "a binary, b binary")


def links(docs: DataFrame, n_sets: int) -> DataFrame:
    """(node, component) of every set that is similar to another, by name; ``docs`` has the texts."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "hyperminhash")
    stored = scratch.store
    n_buckets = max(1, -(-n_sets * BANDS // BUCKET_KEYS))
    ties = stored(_ties(_met(docs, n_buckets)), "ties")
    first = F.conv(F.hex(F.substring("name", 1, 8)), 16, -10).cast("long")
    bitmap = spark.sparkContext.broadcast(marked(_ends(ties).select(first.alias("key"))))
    raw = stored(_tied_sets(docs, bitmap), "sets")
    once = ["n", "times", "registers", "hashes"]
    sets = raw.groupBy("name").agg(*[F.first(c).alias(c) for c in once])
    strongest = ties.groupBy("a").agg(F.max_by("b", F.struct("bands", "b")).alias("b"))
    tried = _similar(strongest, sets, stored)
    found = components(tried.where("linked"), "hyperminhash-components")
    leads = stored(_leads(ties, found, tried), "leads")
    tried = tried.unionByName(_similar(_crossing(leads, found), sets, stored))
    found = components(tried.where("linked"), "hyperminhash-components")
    # Step 5: links between sets of a key whose ties to its first set have failed or were not tried.
    meetings = stored(_meetings(ties, found, leads, stored), "meetings")
    if not meetings.isEmpty():
        more = stored(_met_links(meetings, sets), "met-links")
        found = components(tried.where("linked").select("a", "b").unionByName(more), "hyperminhash-components")
    scratch.free()
    return found


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id`` (the least doc_id connected by similarity), ``kept`` and ``set_id``."""
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    path = work_folder(spark, "hyperminhash-shingled")
    shingled(rows).write.parquet(path)
    named = spark.read.parquet(path)
    sets = named.where("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("least"))
    found = links(rows, sets.count())
    grouped = sets.join(found.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = grouped.join(least, "component").select("name", "component_id")
    out = named.join(answer, "name", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.col("name").alias("set_id"))
