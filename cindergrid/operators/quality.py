"""Data-quality checks. Each returns a DataFrame; each reads its table once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Highest plausible kilograms per scope and row, and the oldest allowed data.
SCOPE_LIMITS_KG = {"scope1_kgco2e": 1e6, "scope2_market_based_kgco2e": 1e7, "scope3_kgco2e": 5e7}
MAX_AGE_DAYS = 90


def _counts(table: DataFrame, conditions: Mapping[str, Column], label: str, value: str) -> DataFrame:
    """One global aggregate over all conditions, turned into one row per condition."""
    names = list(conditions)
    once = table.agg(*[F.count_if(conditions[n]).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias(label), F.col(f"c{i}").alias(value)) for i, n in enumerate(names)]
    )
    return once.select(F.inline(pairs))


def not_null(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for all columns in a single pass."""
    return _counts(table, {c: F.col(c).isNull() for c in columns}, "column_name", "null_count")


def unique(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. NULLs are not_null's business."""
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("duplicate_value"))
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .select(F.lit(column).alias("column_name"), "duplicate_value", "occurrences")
    )


# The declared checks per model, (not_null columns, unique columns).
DECLARED = {
    **{f"raw_{feed}": (["id", at], ["id"]) for feed, at in (
        ("gcp", "usage_month"), ("aws", "usage_month"), ("azure", "usage_month"),
        ("ccf", "usage_date"), ("grid", "timestamp"), ("moer", "point_time"),
    )},
    **{f"stg_{feed}": (["id"], ["id"]) for feed in ("gcp", "aws", "azure", "ccf", "grid", "moer")},
    "fact_cloud_carbon": (["id"], ["id"]),
    "carbon_trends_monthly": (["month", "cloud_provider"], []),
    "fact_grid_intensity": (["grid_region", "timestamp_hour"], []),
    "grid_intensity_daily": (["grid_region", "timestamp_day", "avg_carbon_intensity"], []),
    "dim_grid_regions": (["grid_region"], ["grid_region"]),
}


def _counted_with(table: DataFrame, present: Sequence[str], single: str) -> DataFrame:
    """not_null of ``present`` and unique of ``single`` in one pass: (check_name, column_name, failures)."""
    groups = table.groupBy(F.col(single).cast("string").alias("value")).agg(
        F.count("*").alias("occurrences"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(present)]
    )
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    once = groups.agg(
        total(F.when(F.col("value").isNotNull(), F.col("occurrences") - 1)).alias("extra"),
        *[total(f"c{i}").alias(f"c{i}") for i in range(len(present))],
    )
    row = lambda check, column, value: F.struct(
        F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), F.col(value).alias("failures")
    )
    return once.select(F.inline(F.array(
        *[row("not_null", c, f"c{i}") for i, c in enumerate(present)], row("unique", single, "extra")
    )))


def suite(
    tables: Mapping[str, DataFrame],
    declared: Mapping[str, tuple[Sequence[str], Sequence[str]]] = DECLARED,
    failures: str | None = None,
) -> DataFrame:
    """Every declared check: (table_name, check_name, column_name, failures).

    All not_null checks of a model share one pass, with its first ``unique``, which counts the rows beyond the
    first of each value. With ``failures`` the repeated values are stored below that folder, per model, in
    passes of their own.
    """
    found = []
    for name, (present, single) in declared.items():
        if name not in tables:
            continue
        label, alone = F.lit(name).alias("table_name"), list(single)
        if single and not failures:
            found.append(_counted_with(tables[name], present, alone.pop(0)).select(label, "*"))
        else:
            counted = not_null(tables[name], present)
            found.append(counted.select(
                label, F.lit("not_null").alias("check_name"), "column_name", F.col("null_count").alias("failures")
            ))
        for column in alone:
            repeated = unique(tables[name], column)
            if failures:
                repeated.write.mode("overwrite").parquet(f"{failures}/{name}/unique_{column}")
                repeated = tables[name].sparkSession.read.parquet(f"{failures}/{name}/unique_{column}")
            extra = F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("failures")
            found.append(repeated.agg(extra).select(
                label, F.lit("unique").alias("check_name"), F.lit(column).alias("column_name"), "failures"
            ))
    return reduce(DataFrame.unionByName, found)


def expression_is_true(table: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    """Per rule, the rows where it is false and the rows where it is NULL."""
    names = list(expressions)
    once = table.agg(
        *[F.count_if(~expressions[n]).alias(f"f{i}") for i, n in enumerate(names)],
        *[F.count_if(expressions[n].isNull()).alias(f"n{i}") for i, n in enumerate(names)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                F.col(f"f{i}").alias("false_count"),
                F.col(f"n{i}").alias("null_count"),
            )
            for i, n in enumerate(names)
        ]
    )
    return once.select(F.inline(rows))


def daily_rules() -> dict[str, Column]:
    return {
        "avg_carbon_intensity >= 0": F.col("avg_carbon_intensity") >= 0,
        "distinct_hours <= 24": F.col("distinct_hours") <= 24,
    }


def violations(table: DataFrame, expressions: Mapping[str, Column]) -> DataFrame:
    """The failing rows themselves, with the names of the rules each one breaks."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(e, F.lit(True)), F.lit(n)) for n, e in expressions.items()])
    )
    return table.withColumn("failed_rules", broken).where(F.size("failed_rules") > 0)


def store_violations(table: DataFrame, expressions: Mapping[str, Column], path: str) -> None:
    violations(table, expressions).write.mode("overwrite").parquet(path)


def scope_ranges(fact: DataFrame, limits: Mapping[str, float] = SCOPE_LIMITS_KG) -> DataFrame:
    """Rows per scope that lie outside [0, limit]."""
    conditions = {c: ~F.col(c).between(0, limit) for c, limit in limits.items()}
    return _counts(fact, conditions, "column_name", "out_of_range")


def freshness(
    fact: DataFrame, as_of: Column, by: str = "cloud_provider", at: str = "usage_month_start",
    max_age_days: int = MAX_AGE_DAYS,
) -> DataFrame:
    """Age of the newest row per provider and whether it is still recent enough."""
    age = F.datediff(as_of, F.col("latest")).cast("bigint")
    return (
        fact.groupBy(by)
        .agg(F.max(at).cast("date").alias("latest"))
        .select(by, "latest", age.alias("age_days"), (age <= max_age_days).alias("is_fresh"))
    )


def schema_report(
    tables: Mapping[str, DataFrame | None], required: Mapping[str, Sequence[str]]
) -> DataFrame:
    """(table_name, row_count, missing_columns, status) for the tables that exist.

    A missing column is an error, an empty table a warning. A table that is absent altogether
    has no DataFrame to report on: see :func:`missing_tables`.
    """
    reports = []
    for name, columns in required.items():
        table = tables.get(name)
        if table is None:
            continue
        missing = [c for c in columns if c not in table.columns]
        status = (
            F.lit("error") if missing
            else F.when(F.col("row_count") == 0, "warning").otherwise("ok")
        )
        reports.append(
            table.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(", ".join(missing)).alias("missing_columns"),
                status.alias("status"),
            )
        )
    if not reports:
        raise ValueError("none of the required tables exists")
    return reduce(DataFrame.unionByName, reports)


def missing_tables(
    tables: Mapping[str, DataFrame | None], required: Mapping[str, Sequence[str]]
) -> list[str]:
    return [name for name in required if tables.get(name) is None]


def require_contract(
    tables: Mapping[str, DataFrame | None], required: Mapping[str, Sequence[str]]
) -> list[str]:
    """Gate for dashboards: raises on an absent table or column, returns warnings on empty ones.

    Emptiness is settled by the first row found, not by counting.
    """
    errors = [f"{name}: table is missing" for name in missing_tables(tables, required)]
    warnings = []
    for name, columns in required.items():
        table = tables.get(name)
        if table is None:
            continue
        missing = [c for c in columns if c not in table.columns]
        if missing:
            errors.append(f"{name}: missing columns {', '.join(missing)}")
        elif table.isEmpty():
            warnings.append(f"{name}: no rows")
    if errors:
        raise ValueError("; ".join(errors))
    return warnings
