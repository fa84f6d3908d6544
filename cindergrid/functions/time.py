"""Time helpers. All timestamps are TIMESTAMP_NTZ holding UTC wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def stamped(rows: DataFrame) -> DataFrame:
    """With the moment of processing, which stored marts carry."""
    return rows.withColumn("processed_at", utc_now())


def start_of(unit: str, ts: Column) -> Column:
    """Truncate to hour, day, week (Monday), month or year, staying zone-less."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def month_of(day: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "month")


def day_of_week(ts: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def utc_from_text(text: Column) -> Column:
    """Parse ISO-8601 text with ``Z`` or an offset; malformed text gives NULL."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def iso_utc(ts: Column) -> Column:
    """``2024-01-01T05:00:00+00:00``, with microseconds only where there are any."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.replace(text, F.lit(".000000"), F.lit("")), F.lit("+00:00"))
