from datetime import date

from conftest import plan, rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cindergrid.operators import upsert

SCHEMA = "k string, day date, v int, extra map<string,double>, extracted_at timestamp_ntz"
KEYS = ["k", "day"]


def table(spark, *values):
    """(key, day of month, value, version)"""
    return spark.createDataFrame(
        [(k, date(2024, 1, d), v, {"v": float(v)}, ts(f"2024-02-01 00:00:{n:02d}")) for k, d, v, n in values],
        SCHEMA,
    )


def test_latest_per_key(spark):
    batch = table(spark, ("a", 1, 1, 0), ("a", 1, 2, 5), ("a", 1, 3, 4), ("b", 1, 9, 0), ("b", 1, 8, 0))
    got = upsert.latest_per_key(batch, KEYS).select(*batch.columns)
    # Same version: the larger value, whatever the order of arrival.
    assert rows(got, "k", "v") == [("a", 2), ("b", 9)]


def test_merge(spark):
    target = table(spark, ("a", 1, 1, 0), ("b", 1, 1, 0), (None, 1, 1, 0))
    batch = table(spark, ("b", 1, 2, 1), ("c", 2, 2, 1), (None, 1, 2, 1))
    merged = upsert.merge_upsert(target, batch, KEYS)
    assert rows(merged, "k", "v") == [("a", 1), ("b", 2), ("c", 2), (None, 2)]
    again = upsert.merge_upsert(merged, batch, KEYS)
    assert rows(again, "k", "v") == rows(merged, "k", "v")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 3), st.integers(0, 5)), max_size=8),
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 3), st.integers(0, 5)), max_size=8),
)
def test_merge_like_a_dictionary(spark, old, new):
    base = {(k, d): v for k, d, v in old}
    target = table(spark, *[(k, d, v, 0) for (k, d), v in base.items()])
    batch = table(spark, *[(k, d, v, n) for n, (k, d, v) in enumerate(new)])
    expected = {**base, **{(k, d): v for k, d, v in new}}
    got = {(r.k, r.day.day): r.v for r in upsert.merge_upsert(target, batch, KEYS).collect()}
    assert got == expected


def stored(spark, path):
    return spark.read.schema(SCHEMA).parquet(path)


def test_parquet_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    first = table(spark, ("a", 1, 1, 0), ("a", 2, 1, 0), ("a", 3, 1, 0))
    upsert.upsert_parquet(spark, path, first, KEYS, ["day"])
    untouched = sorted(p.name for p in (tmp_path / "table" / "day=2024-01-02").glob("*.parquet"))
    batch = table(spark, ("a", 1, 5, 1), ("b", 3, 5, 1), ("b", 4, 5, 1))
    for _ in range(2):  # a replay changes nothing
        upsert.upsert_parquet(spark, path, batch, KEYS, ["day"])
        assert [(k, d.day, v) for k, d, v in rows(stored(spark, path), "k", "day", "v")] == [
            ("a", 1, 5), ("a", 2, 1), ("a", 3, 1), ("b", 3, 5), ("b", 4, 5),
        ]
    assert untouched == sorted(p.name for p in (tmp_path / "table" / "day=2024-01-02").glob("*.parquet"))
    assert first.columns == table(spark).columns


def test_upsert_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    upsert.upsert_parquet(spark, path, table(spark, *[("a", d, 1, 0) for d in range(1, 9)]), KEYS, ["day"])
    arriving = table(spark, ("a", 4, 2, 1), ("a", 5, 2, 1))
    touched = upsert.touched_partitions(stored(spark, path), arriving, ["day"])
    filters = [line for line in plan(touched).splitlines() if line.startswith("PartitionFilters")]
    assert any("scalar-subquery" in line or "Subquery" in line for line in filters)
    assert touched.count() == 2


def test_null_partition_survives(spark, tmp_path):
    path = str(tmp_path / "table")
    nulls = spark.createDataFrame(
        [("a", None, 1, {}, ts("2024-01-01")), ("b", None, 1, {}, ts("2024-01-01"))], SCHEMA
    )
    upsert.upsert_parquet(spark, path, nulls, KEYS, ["day"])
    newer = spark.createDataFrame([("a", None, 2, {}, ts("2024-01-02"))], SCHEMA)
    upsert.upsert_parquet(spark, path, newer, KEYS, ["day"])
    assert rows(stored(spark, path), "k", "v") == [("a", 2), ("b", 1)]
