from conftest import rows, ts
from hypothesis import given
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from cindergrid.functions import buckets, measures, time


def test_bucket_edges(spark):
    values = [99.999, 100.0, 249.999, 250.0, 399.9, 400.0, 599.9, 600.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    labels = [r[1] for r in rows(df.select("i", buckets.bucket(F.col("v"))))]
    assert labels == [
        "Very Low", "Low", "Low", "Medium", "Medium", "High", "High", "Very High", "Very High",
    ]


def test_scales_differ(spark):
    df = spark.createDataFrame([(260.0,)], "v double")
    got = df.select(
        buckets.bucket(F.col("v")),
        buckets.bucket(F.col("v"), buckets.WIDE_INTENSITY),
        buckets.bucket(F.col("v"), buckets.CLEANLINESS),
    ).first()
    assert tuple(got) == ("Medium", "Low", "Clean")


@given(st.lists(st.integers(0, 1000), min_size=2, max_size=5))
def test_scale_rejects_unordered_bounds(bounds):
    labels = tuple(str(i) for i in range(len(bounds) + 1))
    if bounds == sorted(bounds):
        assert buckets.Scale(tuple(bounds), labels).labels == labels
    else:
        with pytest.raises(ValueError):
            buckets.Scale(tuple(bounds), labels)


def test_time_helpers(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 13:45:10.5"),), (ts("2023-12-31 23:59:59"),)], "t timestamp_ntz"
    )
    t = F.col("t")
    got = df.select(
        time.start_of("hour", t), time.start_of("week", t), time.day_of_week(t), time.iso_utc(t)
    ).collect()
    # Monday opens the week; Sunday is day 0; the last week of a year may start in December.
    assert tuple(got[0]) == (
        ts("2024-01-01 13:00:00"), ts("2024-01-01 00:00:00"), 1, "2024-01-01T13:45:10.500000+00:00",
    )
    assert tuple(got[1]) == (
        ts("2023-12-31 23:00:00"), ts("2023-12-25 00:00:00"), 0, "2023-12-31T23:59:59+00:00",
    )
    assert df.select(time.start_of("hour", t).alias("x")).schema["x"].dataType.simpleString() == (
        "timestamp_ntz"
    )


def test_utc_from_text(spark):
    df = spark.createDataFrame(
        [(0, "2024-01-01T05:00:00Z"), (1, "2024-01-01T05:00:00+02:00"), (2, "soon")], "i int, s string"
    )
    got = [r[1] for r in rows(df.select("i", time.utc_from_text(F.col("s"))))]
    assert got == [ts("2024-01-01 05:00:00"), ts("2024-01-01 03:00:00"), None]


def test_measures(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (10.0, None)], "a double, b double")
    got = df.select(measures.ratio_if_positive(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [2.5, None, None, None]
    got = df.select(measures.percent_of(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [250.0, 0.0, 0.0, 0.0]
    # NULL makes the id NULL.
    ids = df.select(measures.joined_id(F.lit("x"), F.col("b").cast("string"))).collect()
    assert [r[0] for r in ids] == ["x_4.0", "x_0.0", "x_-1.0", None]
