"""Staging: one lazy projection per feed, on the raw rows that report any emissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.functions.measures import GRAMS_PER_KG, joined_id
from cindergrid.functions.time import month_of, start_of

# Source names.
GRID_SOURCE = "Electricity Maps"
MARGINAL_SOURCE = "WattTime"


def stage_native(raw: DataFrame, provider: str | Column) -> DataFrame:
    """A provider's own monthly report, already in the common column names.

    A NULL scope stays NULL in the market-based total although the raw total counted it as 0.
    """
    provider = F.lit(provider) if isinstance(provider, str) else provider
    return raw.where(F.col("total_kgco2e") > 0).select(
        "id",
        "account_id",
        "service_name",
        "region",
        "usage_month",
        month_of(F.col("usage_month")).alias("usage_month_start"),
        "scope1_kgco2e",
        "scope2_location_based_kgco2e",
        "scope2_market_based_kgco2e",
        "scope3_kgco2e",
        "total_kgco2e",
        (
            F.col("scope1_kgco2e") + F.col("scope2_market_based_kgco2e") + F.col("scope3_kgco2e")
        ).alias("total_market_based_kgco2e"),
        provider.alias("cloud_provider"),
        "extracted_at",
    )


def stage_gcp(raw: DataFrame) -> DataFrame:
    """Keeps ``project_id``; the fact table renames it."""
    common = raw.withColumnsRenamed(
        {"project_id": "account_id", "service_description": "service_name", "location_region": "region"}
    )
    return stage_native(common, "GCP").withColumnRenamed("account_id", "project_id")


def stage_aws(raw: DataFrame) -> DataFrame:
    return stage_native(raw, "AWS")


def stage_azure(raw: DataFrame) -> DataFrame:
    return stage_native(raw.withColumnRenamed("subscription_id", "account_id"), "Azure")


def stage_ccf(raw: DataFrame) -> DataFrame:
    """Daily estimates to months. The days are summed map-side before the one shuffle."""
    scopes = F.col("scope1_kgco2e") + F.col("scope2_kgco2e") + F.col("scope3_kgco2e")
    key = ["cloud_provider", "account_id", "service_name", "region"]
    monthly = (
        raw.where(F.col("total_kgco2e") > 0)
        .groupBy(*key, month_of(F.col("usage_date")).alias("usage_month_start"))
        .agg(
            *[F.sum(c).alias(c) for c in ("scope1_kgco2e", "scope2_kgco2e", "scope3_kgco2e", "total_kgco2e")],
            F.sum(scopes).alias("total_market_based_kgco2e"),
            F.sum("kilowatt_hours").alias("total_kilowatt_hours"),
            F.sum("cost_usd").alias("total_cost_usd"),
            F.max("extracted_at").alias("extracted_at"),
        )
    )
    month = F.date_format("usage_month_start", "yyyy-MM")
    return monthly.select(joined_id(*[F.col(c) for c in key], month).alias("id"), "*")


def stage_grid(raw: DataFrame) -> DataFrame:
    """Average-intensity readings with their hour and day, in grams and kilograms."""
    grams = F.col("carbon_intensity_gco2eq_per_kwh")
    return raw.where(grams > 0).select(
        "id",
        "zone",
        "timestamp",
        start_of("hour", F.col("timestamp")).alias("timestamp_hour"),
        start_of("day", F.col("timestamp")).alias("timestamp_day"),
        grams,
        (grams / GRAMS_PER_KG).alias("carbon_intensity_kgco2eq_per_kwh"),
        "fossil_fuel_percentage",
        "renewable_percentage",
        "low_carbon_percentage",
        (100 - F.col("low_carbon_percentage")).alias("high_carbon_percentage"),
        "power_production_breakdown",
        "power_consumption_breakdown",
        F.lit(GRID_SOURCE).alias("data_source"),
        "extracted_at",
    )


def stage_moer(raw: DataFrame) -> DataFrame:
    """Marginal-rate points with their hour and day."""
    return raw.where(F.col("moer") > 0).select(
        "id",
        "ba",
        "ba_name",
        "point_time",
        start_of("hour", F.col("point_time")).alias("point_time_hour"),
        start_of("day", F.col("point_time")).alias("point_time_day"),
        "moer",
        "moer_kgco2_per_kwh",
        "percent",
        "frequency",
        "market",
        F.lit(MARGINAL_SOURCE).alias("data_source"),
        "extracted_at",
    )
