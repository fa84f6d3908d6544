"""The unified emissions fact and its monthly trends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cindergrid.functions.measures import KG_PER_TONNE, percent_of, ratio_if_positive

_ALIGNED = [
    "id", "cloud_provider", "account_id", "service_name", "region", "usage_month_start",
    "scope1_kgco2e", "scope2_location_based_kgco2e", "scope2_market_based_kgco2e", "scope3_kgco2e",
    "total_market_based_kgco2e", "kilowatt_hours", "cost_usd", "extracted_at",
]


def align_native(staged: DataFrame) -> DataFrame:
    """A staged provider report in the fact's input columns; it has no energy and no cost."""
    if "project_id" in staged.columns:
        staged = staged.withColumnRenamed("project_id", "account_id")
    unknown = F.lit(None).cast("double")
    return staged.withColumns({"kilowatt_hours": unknown, "cost_usd": unknown}).select(*_ALIGNED)


def align_ccf(staged: DataFrame) -> DataFrame:
    """The estimate feed has one scope 2 figure; it fills the location and the market column."""
    return staged.withColumns(
        {
            "scope2_location_based_kgco2e": F.col("scope2_kgco2e"),
            "scope2_market_based_kgco2e": F.col("scope2_kgco2e"),
            "kilowatt_hours": F.col("total_kilowatt_hours"),
            "cost_usd": F.col("total_cost_usd"),
        }
    ).select(*_ALIGNED)


def fact_cloud_carbon(native: list[DataFrame], ccf: DataFrame | None = None) -> DataFrame:
    """UNION ALL of the staged feeds plus the derived measures.

    A provider reported both natively and by the estimate feed counts twice, as the feeds are
    not reconciled. No shuffle: the union and every measure are narrow.
    """
    parts = [align_native(part) for part in native]
    if ccf is not None:
        parts.append(align_ccf(ccf))
    rows = reduce(DataFrame.unionByName, parts)
    total = F.col("total_market_based_kgco2e")
    by_location = (
        F.col("scope1_kgco2e") + F.col("scope2_location_based_kgco2e") + F.col("scope3_kgco2e")
    )
    return rows.select(
        "id",
        "cloud_provider",
        "account_id",
        "service_name",
        "region",
        "usage_month_start",
        "scope1_kgco2e",
        "scope2_location_based_kgco2e",
        "scope2_market_based_kgco2e",
        "scope3_kgco2e",
        total.alias("total_kgco2e"),
        by_location.alias("total_location_based_kgco2e"),
        (total / KG_PER_TONNE).alias("total_mtco2e"),
        "kilowatt_hours",
        "cost_usd",
        ratio_if_positive(total, F.col("cost_usd")).alias("kgco2e_per_dollar"),
        ratio_if_positive(total, F.col("kilowatt_hours")).alias("kgco2e_per_kwh"),
        "extracted_at",
    )


def monthly_emissions(fact: DataFrame) -> DataFrame:
    """Sums and coverage per month, provider and account.

    The fact already holds one row per service, region and month of a feed, so the rows that
    the two distinct counts multiply are few; they are combined map-side before the shuffle.
    """
    measures = {
        "total_kgco2e": "total_kgco2e",
        "total_mtco2e": "total_mtco2e",
        "scope1_kgco2e": "scope1_kgco2e",
        "scope2_kgco2e": "scope2_market_based_kgco2e",
        "scope3_kgco2e": "scope3_kgco2e",
        "total_cost_usd": "cost_usd",
        "total_kwh": "kilowatt_hours",
    }
    return fact.groupBy(
        F.col("usage_month_start").alias("month"), "cloud_provider", "account_id"
    ).agg(
        *[F.sum(source).alias(name) for name, source in measures.items()],
        F.count_distinct("service_name").alias("num_services"),
        F.count_distinct("region").alias("num_regions"),
    )


def trend_label(change_percent):
    """The labels. No usable previous month reads as a new account."""
    return (
        F.when(change_percent > 10, "Increasing ⬆")
        .when(change_percent < -10, "Decreasing ⬇")
        .when(change_percent.isNull(), "New Account")
        .otherwise("Stable ⏸")
    )


def carbon_trends(fact: DataFrame, ordered: bool = True) -> DataFrame:
    """The trends straight from the fact."""
    trends = trends_of_months(monthly_emissions(fact))
    return trends.orderBy(F.desc("month"), "cloud_provider", "account_id") if ordered else trends


def trends_of_months(monthly: DataFrame) -> DataFrame:
    """Month-over-month change, rolling average, year-to-date sum, shares and label.

    The windows run after the monthly aggregate, so an account's partition holds one row per
    month of its history however large the account is. They all cluster on (provider,
    account), hence share one exchange. Months without data are not filled in.
    """
    account = Window.partitionBy("cloud_provider", "account_id").orderBy("month")
    this_year = Window.partitionBy("cloud_provider", "account_id", F.year("month")).orderBy("month")
    total, previous = F.col("total_kgco2e"), F.col("prev_month_kgco2e")
    change = F.col("mom_change_kgco2e")
    return (
        monthly
        .withColumn("prev_month_kgco2e", F.lag("total_kgco2e").over(account))
        .withColumn("rolling_3mo_avg_kgco2e", F.avg("total_kgco2e").over(account.rowsBetween(-2, 0)))
        .withColumn("ytd_total_kgco2e", F.sum("total_kgco2e").over(this_year))
        .withColumn("mom_change_kgco2e", total - previous)
        .withColumn("mom_change_percent", ratio_if_positive(change, previous) * 100)
        .select(
            "month",
            "cloud_provider",
            "account_id",
            "total_kgco2e",
            "total_mtco2e",
            "scope1_kgco2e",
            "scope2_kgco2e",
            "scope3_kgco2e",
            *[percent_of(F.col(f"scope{n}_kgco2e"), total).alias(f"scope{n}_percent") for n in (1, 2, 3)],
            "total_cost_usd",
            "total_kwh",
            ratio_if_positive(total, F.col("total_cost_usd")).alias("kgco2e_per_dollar"),
            ratio_if_positive(total, F.col("total_kwh")).alias("kgco2e_per_kwh"),
            "num_services",
            "num_regions",
            "prev_month_kgco2e",
            "mom_change_kgco2e",
            "mom_change_percent",
            "rolling_3mo_avg_kgco2e",
            "ytd_total_kgco2e",
            trend_label(F.col("mom_change_percent")).alias("trend_indicator"),
        )
    )


def trends_in_tonnes(trends: DataFrame) -> DataFrame:
    """The dashboards' form of the trends, rolling average and running total in tonnes."""
    return trends.withColumns(
        {
            "rolling_3mo_avg_mtco2e": F.col("rolling_3mo_avg_kgco2e") / KG_PER_TONNE,
            "ytd_total_mtco2e": F.col("ytd_total_kgco2e") / KG_PER_TONNE,
        }
    ).drop("rolling_3mo_avg_kgco2e", "ytd_total_kgco2e")
