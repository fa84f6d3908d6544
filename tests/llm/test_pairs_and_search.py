"""Hard negatives, near-duplicates by sketches and ranked search against their plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import text_brute as brute
from pyspark.sql import functions as F
from test_contracts import SCHEMAS, against_oracle
from text_fixtures import SMALL, VECTORS, crowded, docs, empty, folder, items, rows, vectors  # noqa: F401

from cindergrid.llm import bitmaps, hard_negatives, hyperminhash, lexical_search
from cindergrid.llm.queries import QUERIES
from cindergrid.llm.shingles import shingle_sets
from cindergrid.session import work_folder

TEXT = "doc_id long, text string"


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- hard negatives


def test_hard_negatives_of_awkward_rows(spark, folder, crowded):
    df = QUERIES["op11_hard_negatives"](spark, folder)
    assert ",".join(f"{c} {t}" for c, t in df.dtypes) == SCHEMAS["op11_hard_negatives"]
    want = sorted(brute.hard_negatives([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in vectors()]), key=repr)
    assert want and result(df) == want
    assert result(QUERIES["op11_hard_negatives"](spark, crowded)) == want
    assert against_oracle(spark, folder, "op11_hard_negatives")


def test_hard_negatives_over_many_small_blocks(spark, folder, monkeypatch):
    want = result(QUERIES["op11_hard_negatives"](spark, folder))
    for name, value in (("BLOCK_ROWS", 7), ("RUN_ROWS", 30), ("GROUP_RUNS", 2), ("PAGE_RUNS", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert result(QUERIES["op11_hard_negatives"](spark, folder)) == want


def test_hilbert_curve_visits_neighbours():
    """In the order of the keys every cell comes once and differs from the one before by one step."""
    for dims, bits in ((2, 3), (3, 2), (4, 2), (5, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = hard_negatives.hilbert_keys(cells, bits)
        order = sorted(range(len(cells)), key=lambda k: keys[k].tobytes())
        assert len({k.tobytes() for k in keys}) == len(cells)
        assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """Vectors in far groups: an anchor's windows reach few of the blocks, and the answer stays exact."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 4, (40, 8))
    points = [(i, (centres[i % 40] + rng.normal(0, 0.05, 8)).tolist(), i % 3) for i in range(4000)]
    for name, value in (("BLOCK_ROWS", 50), ("RUN_ROWS", 500)):
        monkeypatch.setattr(hard_negatives, name, value)
    asked = []
    needed = hard_negatives._needed

    def counted(*a):
        rows = needed(*a)
        asked.append(rows.count())
        return rows

    monkeypatch.setattr(hard_negatives, "_needed", counted)
    got = result(hard_negatives.mine(spark.createDataFrame(points, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 50))
    anchor = [p for p in points if p[0] == 50][0]
    whole = {p[0]: np.floor(256 * np.array(p[1])).astype(int) for p in points}
    score = {i: int(v @ whole[50]) for i, v in whole.items()}
    label = {i: k for i, _, k in points}
    best = sorted((-score[i], i) for i in label if i != 50 and label[i] == anchor[2])[:5]
    want = []
    for p, i in best:
        fits = sorted((-score[j], j) for j in label if label[j] != anchor[2] and 50 * -p <= 100 * score[j] <= 95 * -p)[:3]
        want += [(50, i, k + 1, j, -p, -s) for k, (s, j) in enumerate(fits)]
    assert got == sorted(want, key=repr)
    assert asked[0] < 20  # of 80 blocks


def test_bounds_hold_for_every_row(spark):
    rng = np.random.default_rng(5)
    rows = rng.integers(-300, 300, (64, 5))
    group = object.__new__(hard_negatives._Group)
    values = rng.integers(-300, 300, (9, 5)).astype(float)
    group.up, group.down = np.maximum(values, 0), np.minimum(values, 0)
    least, most = group.bounds(rows.min(0), rows.max(0))
    scores = values @ rows.T
    assert (least[:, None] <= scores).all() and (scores <= most[:, None]).all()


def test_scores_beyond_56_bits_are_refused(spark):
    rows = spark.createDataFrame([(1, [1e9, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="56 bits"):
        hard_negatives.mine(rows, F.col("vec_id") == 1)


# --- near-duplicates by sketches


def edited(rng, text, share):
    words = text.split()
    for k in rng.sample(range(len(words)), int(len(words) * share)):
        words[k] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_around_the_threshold(spark, tmp_path):
    """Chains of edits whose similarity lies around 0.8, sizes from one word up, and a group of many near copies."""
    rng = random.Random(12)
    texts = []
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 25, 40, 80, 200, 600, 1300, 2000, 2600]:
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
        texts.append(base)
        for _ in range(6):
            texts.append(edited(rng, texts[-1], rng.choice([0.02, 0.05, 0.06, 0.08])))
        texts += [" ".join(base.split()[: max(1, int(n * 0.81))]), base + " more", base.upper()]
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))
    texts += [edited(rng, base, rng.choice([0.02, 0.04, 0.06])) for _ in range(150)]
    rows = [(3 * k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, TEXT).repartition(4)).collect()}
    assert got == brute.components(rows, 2)


@pytest.mark.parametrize(("homes", "sent"), [(7, 32), (2000, 2)])
def test_pairs_left_by_failed_ties_are_tried(spark, monkeypatch, homes, sent):
    """With one key for nearly all sets, the stars are refuted and only step 5 can find the links."""
    rng = random.Random(13)
    rows = []
    for k in range(30):
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
        rows += [(2 * k, base), (2 * k + 1, base + " more")]
    monkeypatch.setattr(hyperminhash, "band_keys", lambda found, times: np.full((len(found), 1), times, np.uint64))
    monkeypatch.setattr(hyperminhash, "HOME_SETS", homes)
    monkeypatch.setattr(hyperminhash, "SENT", sent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, TEXT)).collect()}
    assert got == brute.components(rows, 2)


def test_ids_and_repeated_rows_of_near_duplicates(spark):
    text = "one two three four five six"
    rows = [(None, text), (7, text), (7, text), (None, "alone here it stands"), (None, None), (9, ""), (9, " \t")]
    got = [tuple(r) for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, TEXT)).drop("set_id").collect()]
    assert sorted(got, key=repr) == sorted(
        [(None, 5, 7, False), (7, 5, 7, True), (7, 5, 7, True), (None, 3, None, True), (None, 0, None, True), (9, 0, 9, True), (9, 0, 9, True)], key=repr
    )


def test_estimates_are_close_and_corrected():
    rng = np.random.default_rng(6)
    for n in (5, 30, 700, 5000):
        pool = np.unique(rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64))[: n + n // 5]
        one, other = pool[:n], pool[n // 5 :]
        times = hyperminhash.copies(n)
        a, b = hyperminhash.registers([one, other], times)
        true = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
        assert abs(hyperminhash.estimate(a, b, len(one), len(other)) - true) < 0.09
        assert hyperminhash.estimates(a, np.stack([b, a]), len(one), np.array([len(other), len(one)])).tolist() == [
            hyperminhash.estimate(a, b, len(one), len(other)), hyperminhash.estimate(a, a, len(one), len(one))
        ]
    # Sets without a common shingle: with a short mantissa many registers agree by chance, and the correction takes them out.
    ones = [rng.integers(1, 1 << 63, 4000, dtype=np.uint64) for _ in range(40)]
    found = hyperminhash.registers(ones, 1) >> np.uint16(8)
    raw = np.mean([np.mean(a == b) for a, b in zip(found[::2], found[1::2], strict=True)])
    assert abs(raw - hyperminhash.CHANCE / 4 / 4) < 0.015


def test_similar_sets_have_a_grade_in_common():
    for n in range(4, 6000):
        for m in (n, math.ceil(n * 0.8), n - 1):
            if 100 * m >= 80 * n:
                assert set(hyperminhash.grades(n)) & set(hyperminhash.grades(m))


def test_shingles_of_two_words():
    for text in ("a", "a b", "a b a b a", " x  y\tz "):
        assert len(shingle_sets([text.encode()], 2)[0]) == len(brute.shingles(text, 2))


# --- ranked search


def test_search_of_awkward_documents(spark, folder, rows, items, crowded):
    df = QUERIES["op13_lexical_search"](spark, folder)
    assert ",".join(f"{c} {t}" for c, t in df.dtypes) == SCHEMAS["op13_lexical_search"]
    want = brute.ranked([(i, t) for i, t, *_ in rows], items)
    assert want and result(df) == sorted(want, key=repr)
    twice = brute.ranked(2 * [(i, t) for i, t, *_ in rows], items)
    assert result(QUERIES["op13_lexical_search"](spark, crowded)) == sorted(twice, key=repr)
    assert against_oracle(spark, folder, "op13_lexical_search")


def test_search_in_parts_and_small_blocks(spark, folder, rows, items, monkeypatch):
    for name, value in (("PART_TERMS", 12), ("BLOCK_BITS", 1 << 9), ("ENTRY_BITS", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    got = result(QUERIES["op13_lexical_search"](spark, folder))
    assert got == sorted(brute.ranked([(i, t) for i, t, *_ in rows], items), key=repr)


def test_search_ties_and_missing_ids(spark):
    rows = [(None, "lamp stone"), (5, "lamp stone"), (3, "stone lamp"), (3, "lamp stone"), (4, None), (6, ""), (8, "other words")]
    rows += [(100 + k, f"filler{k} text") for k in range(40)]
    asked = [(1, "lamp"), (2, None), (None, "stone stone"), (3, "nothing of it")]
    docs = spark.createDataFrame(rows, TEXT)
    index = lexical_search.build(docs, work_folder(spark, "test-index"))
    got = result(lexical_search.search(docs, index, spark.createDataFrame(asked, "item_id long, text string"), most=3))
    assert got == sorted(brute.ranked(rows, asked, 3), key=repr)


def test_bounds_are_never_below_the_scores(spark, docs, rows, items):
    index = lexical_search.build(docs, work_folder(spark, "test-bounds"))
    words = {i: lexical_search.terms((t or "").encode()) for i, t, *_ in rows}
    held = {i: w for i, w in words.items() if w}
    from collections import Counter

    part = lexical_search._Part([(k, Counter(lexical_search.terms((t or "").encode()))) for k, (_, t) in enumerate(items)])
    df = Counter(t for w in held.values() for t in set(w))
    part.weigh(len(held), sum(map(len, held.values())), {k: df[t] for k, t in enumerate(part.terms)})
    seen = 0
    for row in index.collect():
        bounds = part.bounds(row.asDict())
        for j, i in enumerate(row["ids"]):
            seen += 1
            for k, s in part.scores(held[i]).items():
                assert bounds[k, j] >= s
    assert seen == len(held)


def test_bitmap_holds_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    bitmap = bitmaps.marked(spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(4), 14)
    assert len(bitmap) == 1 << 11 and bitmaps.holds(bitmap, keys, 14).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert bitmaps.holds(bitmap, others, 14).mean() < 0.4


def test_a_set_goes_on_from_a_first_one_by_its_own_keys_only(spark):
    from cindergrid.llm import hyperminhash

    keys = np.array([3, 3 + 64, 3 + 128], np.uint64)
    assert hyperminhash._slots(keys).tolist() == [[8, 0], [0, 8], [8, 0]]
    rows = [("s", "x", True, 1), ("x", "h1", False, 1), ("x", "h2", False, 2), ("x", "h3", False, 4), ("t", "h1", False, 8)]
    rows = [(a.encode(), b.encode(), 1, near, low, 0) for a, b, near, low in rows]
    ties = spark.createDataFrame(rows, "a binary, b binary, bands long, near boolean, low long, high long")
    found = spark.createDataFrame([], "node binary, component binary")
    places: dict = {}
    for r in hyperminhash._meetings(ties, found).collect():
        places.setdefault(bytes(r["home"]), set()).add(bytes(r["name"]))
    assert places == {b"h1": {b"s", b"x", b"t", b"h1"}}


def test_two_components_try_one_of_the_ties_between_them(spark, monkeypatch):
    """Two groups of near copies that share keys but no link: few pairs are asked for, however many ties lead across."""
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))
    texts = [edited(rng, t, 0.01) for t in (base, edited(rng, base, 0.12)) for _ in range(150)]
    rows = list(enumerate(texts))
    asked, similar = [], hyperminhash._similar

    def counted(pairs, sets, stored):
        asked.append(pairs.count())
        return similar(pairs, sets, stored)

    monkeypatch.setattr(hyperminhash, "_similar", counted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, TEXT)).collect()}
    assert got == brute.components(rows, 2) and len({c for _, c in got.values()}) == 2
    assert asked[0] < 300 and asked[1] <= 3


def test_ties_by_an_earlier_component_lead_to_what_it_has_grown_into(spark):
    rows = [("s", "h1", True, 3), ("s", "h2", False, 1), ("t", "h2", False, 4), ("u", "h3", False, 2), ("h1", "h0", False, 1), ("h3", "h0", False, 9)]
    rows = [(a.encode(), b.encode(), n, near, n, 0) for a, b, near, n in rows]
    ties = spark.createDataFrame(rows, "a binary, b binary, bands long, near boolean, low long, high long")
    kind = "node binary, component binary"
    earlier = spark.createDataFrame([(b"h1", b"h0"), (b"h0", b"h0")], kind)
    grown = spark.createDataFrame([(b"h1", b"h0"), (b"h2", b"h0"), (b"h0", b"h0")], kind)
    tried = ties.where("a = 'h1'").select("a", "b")
    leads = hyperminhash._leads(ties, earlier, tried)
    assert result(hyperminhash._crossing(leads, earlier)) == sorted((a.encode(), b.encode()) for a, b in [("s", "h1"), ("s", "h2"), ("t", "h2"), ("u", "h3"), ("h3", "h0")])
    assert result(hyperminhash._meetings(ties, grown, leads)) == result(hyperminhash._meetings(ties, grown))
