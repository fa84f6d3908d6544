"""Load windows: where a first load starts, where the next one resumes, where it ends."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.schemas import RAW_PERIOD


@dataclass(frozen=True)
class LoadWindow:
    cursor: str  # the raw column that carries the high-water mark
    lookback: int  # first load: this many months, days or hours back
    unit: str  # "month", "day" or "hour"
    step: str | None  # added to the mark on resume; None re-reads the last period
    open_month: bool = True  # False: stop before the current, incomplete month


# Load rules per feed.
LOAD_WINDOWS = {
    "gcp": LoadWindow("usage_month", 3, "month", None),
    "aws": LoadWindow("usage_month", 3, "month", "INTERVAL 1 DAY", open_month=False),
    "azure": LoadWindow("usage_month", 3, "month", "INTERVAL 1 DAY", open_month=False),
    "ccf": LoadWindow("usage_date", 90, "day", "INTERVAL 1 DAY"),
    "grid": LoadWindow("timestamp", 24, "hour", "INTERVAL 1 HOUR"),
    "moer": LoadWindow("point_time", 24, "hour", "INTERVAL 5 MINUTES"),
}


def load_period(feed: str) -> Column:
    """The raw table's partition: a function of the key, so a row never changes partition."""
    rule = LOAD_WINDOWS[feed]
    day = F.col(rule.cursor).cast("date")
    return day if rule.unit == "hour" else F.trunc(day, "month")


def from_month(rows: DataFrame, feed: str, month: date) -> DataFrame:
    """Raw rows of ``month`` and later; on a stored raw table earlier partitions are skipped."""
    rule = LOAD_WINDOWS[feed]
    first = F.lit(month.replace(day=1))
    kind = "timestamp_ntz" if rule.unit == "hour" else "date"
    rows = rows.where(F.col(rule.cursor) >= first.cast(kind))
    return rows.where(F.col(RAW_PERIOD) >= first) if RAW_PERIOD in rows.columns else rows


def in_months(rows: DataFrame, feed: str, months: Collection[date]) -> DataFrame:
    """Raw rows of exactly these months; on a stored raw table all other partitions are skipped."""
    chosen = [F.lit(m) for m in months]
    rows = rows.where(F.trunc(F.col(LOAD_WINDOWS[feed].cursor).cast("date"), "month").isin(chosen))
    return rows.where(F.trunc(RAW_PERIOD, "month").isin(chosen)) if RAW_PERIOD in rows.columns else rows


def lookback_start(feed: str, as_of: Column, lookback: int | None = None) -> Column:
    """First load: N*30 days back to the start of that month, N days back, or N hours back."""
    rule = LOAD_WINDOWS[feed]
    n = rule.lookback if lookback is None else lookback
    if rule.unit == "month":
        return F.trunc(F.date_sub(as_of.cast("date"), 30 * n), "month")
    if rule.unit == "day":
        return F.date_sub(as_of.cast("date"), n)
    return as_of.cast("timestamp_ntz") - F.expr(f"INTERVAL {n} HOURS")


def resume_start(feed: str, last: Column) -> Column:
    """Next load: the mark itself for the feed that re-reads its last month, else one step on."""
    rule = LOAD_WINDOWS[feed]
    if rule.step is None:
        return last
    if rule.unit == "hour":
        return last + F.expr(rule.step)
    return F.date_add(last, 1)


def in_window(feed: str, start: Column, as_of: Column) -> Column:
    """Whether a row lies between ``start`` and ``as_of``; plain comparisons, so they reach the scan."""
    rule = LOAD_WINDOWS[feed]
    at = F.col(rule.cursor)
    if not rule.open_month:
        end = at < F.trunc(as_of.cast("date"), "month")
    elif rule.unit == "hour":
        end = at <= as_of.cast("timestamp_ntz")
    else:
        end = at <= as_of.cast("date")
    return (at >= start) & end


def within_window(rows: DataFrame, feed: str, start: Column, as_of: Column) -> DataFrame:
    return rows.where(in_window(feed, start, as_of))


def initial_load(rows: DataFrame, feed: str, as_of: Column, lookback: int | None = None) -> DataFrame:
    return within_window(rows, feed, lookback_start(feed, as_of, lookback), as_of)


def incremental_since(
    rows: DataFrame, loaded: DataFrame, feed: str, as_of: Column, lookback: int | None = None
) -> DataFrame:
    """What a request to the provider must still ask for: after the target's own maximum, or the
    first-load window. Landed files are loaded whole, see ``plans.refresh``.

    The mark is a scalar subquery over the target, so nothing is collected and the stored
    state can never disagree with the table.
    """
    mark = loaded.agg(F.max(LOAD_WINDOWS[feed].cursor)).scalar()
    start = F.coalesce(resume_start(feed, mark), lookback_start(feed, as_of, lookback))
    return within_window(rows, feed, start, as_of)
