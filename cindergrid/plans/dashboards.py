"""The dashboard queries over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.functions.measures import KG_PER_TONNE
from cindergrid.functions.time import start_of

# --- overview ----------------------------------------------------------------------------


def cloud_totals(fact: DataFrame) -> DataFrame:
    """Per provider: tonnes in total and by scope, accounts and services seen."""
    scopes = {
        "scope1_mtco2e": "scope1_kgco2e",
        "scope2_mtco2e": "scope2_market_based_kgco2e",
        "scope3_mtco2e": "scope3_kgco2e",
    }
    collapsed = fact.groupBy("cloud_provider", "account_id", "service_name").agg(
        F.sum("total_mtco2e").alias("total_mtco2e"),
        *[F.sum(source).alias(name) for name, source in scopes.items()],
    )
    return (
        collapsed.groupBy("cloud_provider")
        .agg(
            F.sum("total_mtco2e").alias("total_mtco2e"),
            *[(F.sum(name) / KG_PER_TONNE).alias(name) for name in scopes],
            F.count_distinct("account_id").alias("num_accounts"),
            F.count_distinct("service_name").alias("num_services"),
        )
        .orderBy(F.desc_nulls_last("total_mtco2e"), "cloud_provider")
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("usage_month_start", "cloud_provider")
        .agg(F.sum("total_mtco2e").alias("total_mtco2e"))
        .orderBy("usage_month_start", "cloud_provider")
    )


def scope_breakdown(fact: DataFrame) -> DataFrame:
    """The three global sums as rows: one scan and one aggregate, unpivoted."""
    labels = {
        "Scope 1": "scope1_kgco2e",
        "Scope 2 (Market-Based)": "scope2_market_based_kgco2e",
        "Scope 3": "scope3_kgco2e",
    }
    sums = fact.agg(*[(F.sum(c) / KG_PER_TONNE).alias(label) for label, c in labels.items()])
    return sums.unpivot([], [F.col(f"`{label}`") for label in labels], "scope", "mtco2e")


# --- trends ------------------------------------------------------------------------------


def latest_trends(trends: DataFrame) -> DataFrame:
    """The 100 newest rows. Input in tonnes: see ``emissions.trends_in_tonnes``."""
    return (
        trends.select(
            "month", "cloud_provider", "account_id", "total_mtco2e", "mom_change_percent",
            "rolling_3mo_avg_mtco2e", "ytd_total_mtco2e", "trend_indicator",
            "scope1_percent", "scope2_percent", "scope3_percent",
        )
        .orderBy(F.desc("month"), "cloud_provider", "account_id")
        .limit(100)
    )


def mom_change(trends: DataFrame) -> DataFrame:
    return (
        trends.where(F.col("mom_change_percent").isNotNull())
        .select("month", "cloud_provider", "mom_change_percent")
        .orderBy("month", "cloud_provider")
    )


def year_to_date(trends: DataFrame) -> DataFrame:
    return trends.select("month", "cloud_provider", "ytd_total_mtco2e").orderBy(
        "month", "cloud_provider"
    )


# --- datacenters -------------------------------------------------------------------------


def datacenter_emissions(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("region").isNotNull())
        .groupBy("cloud_provider", F.col("region").alias("datacenter_region"), "service_name")
        .agg(
            F.sum("total_mtco2e").alias("total_emissions_mtco2e"),
            F.count_distinct("usage_month_start").alias("months_of_data"),
            F.avg("total_mtco2e").alias("avg_monthly_emissions"),
        )
        .orderBy(
            F.desc_nulls_last("total_emissions_mtco2e"),
            "cloud_provider", "datacenter_region", "service_name",
        )
    )


def datacenter_totals(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("region").isNotNull())
        .groupBy("cloud_provider", F.col("region").alias("datacenter_region"))
        .agg(
            F.sum("total_mtco2e").alias("total_emissions_mtco2e"),
            F.count_distinct("service_name").alias("num_services"),
        )
        .orderBy(
            F.desc_nulls_last("total_emissions_mtco2e"), "cloud_provider", "datacenter_region"
        )
    )


def datacenter_mapping(dim: DataFrame) -> DataFrame:
    return (
        dim.where(F.col("cloud_providers").isNotNull())
        .select(
            "grid_region", F.col("region_name").alias("grid_region_name"), "country",
            "cloud_providers", "gcp_regions", "aws_regions", "azure_regions",
            "latitude", "longitude",
        )
        .orderBy("grid_region")
    )


def datacenter_map(with_grid: DataFrame) -> DataFrame:
    return with_grid.where(F.col("total_emissions_mtco2e") > 0).select(
        "cloud_provider", "datacenter_region", "grid_region_name", "grid_avg_intensity",
        "total_emissions_mtco2e", F.col("latitude").alias("lat"), F.col("longitude").alias("long"),
    )


def cleanest_datacenters(with_grid: DataFrame) -> DataFrame:
    """The ten emitting datacenters on the cleanest grids; unread grids come last."""
    return (
        with_grid.where(F.col("total_emissions_mtco2e") > 0)
        .orderBy(
            F.asc_nulls_last("grid_avg_intensity"),
            "cloud_provider", "datacenter_region", "grid_region",
        )
        .limit(10)
        .select(
            "cloud_provider", "datacenter_region", "grid_region_name", "country",
            "grid_avg_intensity", "cleanliness_category", "total_emissions_mtco2e",
        )
    )


# --- grid --------------------------------------------------------------------------------


def recent(fact: DataFrame, days: int) -> DataFrame:
    """Rows within ``days`` of the newest hour.

    The newest month comes first, then the newest hour within it: on the stored fact, which is
    partitioned by month, the bound costs one partition and no column of the others. Both are
    scalar subqueries; the hour is pushed into the scan, and the month skips older partitions.
    """
    last_month = fact.agg(F.max("timestamp_month").alias("month")).scalar()
    last = fact.where(F.col("timestamp_month") == last_month).agg(
        (F.max("timestamp_hour") - F.expr(f"INTERVAL {days} DAYS")).alias("since")
    )
    since = last.scalar()
    return fact.where(
        (F.col("timestamp_hour") >= since) & (F.col("timestamp_month") >= start_of("month", since))
    )


def current_intensity(fact: DataFrame) -> DataFrame:
    return (
        recent(fact, 1)
        .select(
            "grid_region", "timestamp_hour", "carbon_intensity_gco2eq_per_kwh",
            "intensity_category", "fossil_fuel_percentage", "renewable_percentage", "data_source",
        )
        .orderBy(
            F.desc_nulls_last("carbon_intensity_gco2eq_per_kwh"),
            "grid_region", "timestamp_hour", "data_source",
        )
    )


def intensity_trend(fact: DataFrame) -> DataFrame:
    return (
        recent(fact, 7)
        .select("timestamp_hour", "grid_region", "carbon_intensity_gco2eq_per_kwh")
        .orderBy("timestamp_hour", "grid_region")
    )


def by_category(fact: DataFrame) -> DataFrame:
    return (
        recent(fact, 7)
        .groupBy("intensity_category")
        .agg(
            F.count("*").alias("count"),
            F.avg("carbon_intensity_gco2eq_per_kwh").alias("avg_intensity"),
        )
        .orderBy(F.desc_nulls_last("avg_intensity"))
    )


def map_data(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Last day's means per region with its place.

    Aggregated by region before the join, as the dimension holds one row per region: the
    join then meets a handful of rows and the shuffle key is a single short string.
    """
    means = recent(fact, 1).groupBy("grid_region").agg(
        F.avg("carbon_intensity_gco2eq_per_kwh").alias("avg_intensity"),
        F.avg("fossil_fuel_percentage").alias("avg_fossil"),
        F.avg("renewable_percentage").alias("avg_renewable"),
    )
    return means.join(dim, "grid_region").select(
        "grid_region", "region_name", "city", "country", "cloud_providers",
        "avg_intensity", "avg_fossil", "avg_renewable",
        F.col("latitude").alias("lat"), F.col("longitude").alias("long"),
    )


def _last_week(daily: DataFrame, as_of: Column | date | None) -> DataFrame:
    """Days from a week before ``as_of`` (today if not given) on."""
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, date):
        as_of = F.lit(as_of)
    return daily.where(F.col("date") >= F.date_sub(as_of, 7))


def daily_averages(daily: DataFrame, dim: DataFrame, as_of: Column | date | None = None) -> DataFrame:
    """``daily`` in the dashboards' names: see ``grid.daily_for_dashboards``."""
    return (
        _last_week(daily, as_of)
        .join(dim.select("grid_region", "region_name", "country"), "grid_region")
        .select(
            "date", "grid_region", "region_name", "country", "avg_intensity",
            "avg_fossil_percentage", "avg_renewable_percentage",
        )
        .orderBy(F.desc("date"), F.desc_nulls_last("avg_intensity"), "grid_region")
    )


def weekly_comparison(
    daily: DataFrame, dim: DataFrame, as_of: Column | date | None = None
) -> DataFrame:
    """The twenty cleanest regions of the last week, by the mean of their daily means."""
    week = _last_week(daily, as_of).groupBy("grid_region").agg(
        F.avg("avg_intensity").alias("avg_intensity"),
        F.avg("avg_fossil_percentage").alias("avg_fossil"),
        F.avg("avg_renewable_percentage").alias("avg_renewable"),
        F.min("avg_intensity").alias("min_intensity"),
        F.max("avg_intensity").alias("max_intensity"),
    )
    return (
        week.join(dim.select("grid_region", "region_name", "country"), "grid_region")
        .select(
            "grid_region", "region_name", "country", "avg_intensity", "avg_fossil",
            "avg_renewable", "min_intensity", "max_intensity",
        )
        .orderBy(F.asc_nulls_last("avg_intensity"), "grid_region")
        .limit(20)
    )


def monthly_regional_trends(monthly: DataFrame, dim: DataFrame) -> DataFrame:
    return (
        monthly.join(dim.select("grid_region", "region_name", "country"), "grid_region")
        .select(
            "month_start", "grid_region", "region_name", "country", "avg_intensity",
            "avg_fossil_percentage", "avg_renewable_percentage",
        )
        .orderBy(F.desc("month_start"), F.asc_nulls_last("avg_intensity"), "grid_region")
    )
