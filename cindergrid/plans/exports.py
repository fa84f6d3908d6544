"""Exports of named marts to Parquet and CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Public table names, and the columns that make the order of an export total.
EXPORTS = {
    "cloud_carbon": (
        "fact_cloud_carbon",
        ("usage_month_start", "id", "cloud_provider", "account_id", "service_name", "region", "total_kgco2e"),
    ),
    "grid_intensity": ("fact_grid_intensity", ("timestamp_hour", "grid_region", "data_source")),
    "trends": ("carbon_trends_monthly", ("month", "cloud_provider", "account_id")),
}
# Quotes inside a field are doubled, as CSV readers expect; the default would be a backslash.
CSV = {"header": "true", "escape": '"'}


def _named(marts: Mapping[str, DataFrame], name: str) -> tuple[DataFrame, Sequence[str]]:
    if name not in EXPORTS:
        raise KeyError(f"no table {name!r} to export; there are {sorted(EXPORTS)}")
    mart, order = EXPORTS[name]
    return marts[mart], order


def export_parquet(marts: Mapping[str, DataFrame], name: str, path: str) -> None:
    """The whole mart, written by all tasks in parallel."""
    _named(marts, name)[0].write.mode("overwrite").parquet(path)


def export_csv(
    marts: Mapping[str, DataFrame], name: str, path: str, limit: int | None = None
) -> None:
    """The whole mart in a fixed order, or its first ``limit`` rows.

    Without a limit the rows are sorted by range, so all tasks write; with one each task sends
    its own first rows only.
    """
    if limit is not None and limit < 1:
        raise ValueError(f"limit must be at least 1, not {limit}")
    table, order = _named(marts, name)
    ranked = table.orderBy(*[F.asc_nulls_last(c) for c in order])
    if limit is not None:
        ranked = ranked.limit(limit)
    ranked.write.mode("overwrite").options(**CSV).csv(path)


def dump_csv(marts: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """All three marts in full, with the row counts seen while writing (no second pass)."""
    counts = {}
    for mart, _ in EXPORTS.values():
        seen = Observation(mart)
        rows = marts[mart].observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").options(**CSV).csv(f"{folder}/{mart}")
        counts[mart] = seen.get["rows"]
    return counts
