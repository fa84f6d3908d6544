"""Feed normalisers: landed records in, typed raw rows out.

Every normaliser is a narrow projection (plus ``explode`` for nested feeds), so it runs
inside the scan stage without any shuffle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.functions.measures import KG_PER_TONNE, joined_id, pounds_per_mwh_to_kg_per_kwh
from cindergrid.functions.time import iso_utc, utc_from_text, utc_now


def _or(column: Column, default) -> Column:
    return F.coalesce(column, F.lit(default))


def normalise_gcp(
    landed: DataFrame, min_month: date | Column | None = None, extracted_at: Column | None = None
) -> DataFrame:
    """Flatten the nested table export. The total treats missing scopes as 0, the scopes stay NULL."""
    if min_month is not None:
        landed = landed.where(F.col("usage_month") >= min_month)
    footprint = F.col("carbon_footprint_kgCO2e")
    scope1, scope2, scope3 = footprint["scope1"], footprint["scope2"], footprint["scope3"]
    project, service, region = F.col("project.id"), F.col("service.description"), F.col("location.region")
    return landed.select(
        joined_id(project, service, region, F.date_format("usage_month", "yyyy-MM")).alias("id"),
        project.alias("project_id"),
        service.alias("service_description"),
        region.alias("location_region"),
        "usage_month",
        scope1.alias("scope1_kgco2e"),
        scope2["location_based"].alias("scope2_location_based_kgco2e"),
        scope2["market_based"].alias("scope2_market_based_kgco2e"),
        scope3.alias("scope3_kgco2e"),
        (_or(scope1, 0.0) + _or(scope2["location_based"], 0.0) + _or(scope3, 0.0)).alias("total_kgco2e"),
        (utc_now() if extracted_at is None else extracted_at).alias("extracted_at"),
    )


def _normalise_tonnes(
    landed: DataFrame, key: str, account: str | Column, extracted_at: Column | None
) -> DataFrame:
    account = F.lit(account) if isinstance(account, str) else account
    month = F.to_date("Month")

    def kg(*names: str) -> Column:
        tonnes = _or(F.col(names[0]), 0.0)
        for name in names[1:]:
            tonnes = tonnes + _or(F.col(name), 0.0)
        return tonnes * KG_PER_TONNE

    return landed.select(
        # The id says "unknown" in lower case where the column says "Unknown".
        joined_id(
            account,
            _or(F.col("ServiceName"), "unknown"),
            _or(F.col("Region"), "global"),
            F.date_format(month, "yyyy-MM-dd"),
        ).alias("id"),
        account.alias(key),
        _or(F.col("ServiceName"), "Unknown").alias("service_name"),
        _or(F.col("Region"), "global").alias("region"),
        month.alias("usage_month"),
        kg("Scope1").alias("scope1_kgco2e"),
        kg("Scope2LocationBased").alias("scope2_location_based_kgco2e"),
        kg("Scope2MarketBased").alias("scope2_market_based_kgco2e"),
        kg("Scope3").alias("scope3_kgco2e"),
        kg("Scope1", "Scope2LocationBased", "Scope3").alias("total_kgco2e"),
        (utc_now() if extracted_at is None else extracted_at).alias("extracted_at"),
    )


def normalise_aws(
    landed: DataFrame, account: str | Column, extracted_at: Column | None = None
) -> DataFrame:
    """Tonnes to kilograms, defaults for missing fields, keyed by account."""
    return _normalise_tonnes(landed, "account_id", account, extracted_at)


def normalise_azure(
    landed: DataFrame, subscription: str | Column, extracted_at: Column | None = None
) -> DataFrame:
    """The same record shape keyed by subscription."""
    return _normalise_tonnes(landed, "subscription_id", subscription, extracted_at)


def normalise_ccf(landed: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One row per service estimate of a day. An empty array yields no row."""
    estimates = landed.select(
        F.to_date(F.substring("timestamp", 1, 10)).alias("usage_date"),
        F.explode("serviceEstimates").alias("e"),
    )
    provider = _or(F.col("e.cloudProvider"), "Unknown")
    account = F.coalesce("e.accountId", "e.accountName", F.lit("unknown"))
    service, region = _or(F.col("e.serviceName"), "Unknown"), _or(F.col("e.region"), "global")
    scopes = [_or(F.col(f"e.scope{n}"), 0.0) for n in (1, 2, 3)]
    day = F.date_format("usage_date", "yyyy-MM-dd")
    return estimates.select(
        joined_id(provider, account, service, region, day).alias("id"),
        provider.alias("cloud_provider"),
        account.alias("account_id"),
        service.alias("service_name"),
        region.alias("region"),
        "usage_date",
        *[scope.alias(f"scope{n}_kgco2e") for n, scope in enumerate(scopes, start=1)],
        (scopes[0] + scopes[1] + scopes[2]).alias("total_kgco2e"),
        _or(F.col("e.kilowattHours"), 0.0).alias("kilowatt_hours"),
        _or(F.col("e.cost"), 0.0).alias("cost_usd"),
        (utc_now() if extracted_at is None else extracted_at).alias("extracted_at"),
    )


def normalise_grid_history(landed: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One row per zone and reading; missing numbers become 0, missing breakdowns an empty map."""
    readings = landed.select("zone", F.explode("history").alias("h")).withColumn(
        "timestamp", utc_from_text(F.col("h.datetime"))
    )
    no_breakdown = F.create_map().cast("map<string,double>")
    return readings.select(
        joined_id(F.col("zone"), iso_utc(F.col("timestamp"))).alias("id"),
        "zone",
        "timestamp",
        _or(F.col("h.carbonIntensity"), 0.0).alias("carbon_intensity_gco2eq_per_kwh"),
        _or(F.col("h.fossilFuelPercentage"), 0.0).alias("fossil_fuel_percentage"),
        _or(F.col("h.renewablePercentage"), 0.0).alias("renewable_percentage"),
        _or(F.col("h.lowCarbonPercentage"), 0.0).alias("low_carbon_percentage"),
        F.coalesce("h.powerProductionBreakdown", no_breakdown).alias("power_production_breakdown"),
        F.coalesce("h.powerConsumptionBreakdown", no_breakdown).alias("power_consumption_breakdown"),
        (utc_now() if extracted_at is None else extracted_at).alias("extracted_at"),
    )


def normalise_moer(landed: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One row per balancing authority and five-minute point, with the rate in both units."""
    points = landed.select("ba", F.explode("data").alias("p")).withColumn(
        "point_time", utc_from_text(F.col("p.point_time"))
    )
    rate = _or(F.col("p.value"), 0.0)
    return points.select(
        joined_id(F.col("ba"), iso_utc(F.col("point_time"))).alias("id"),
        "ba",
        F.coalesce("p.ba_name", "ba").alias("ba_name"),
        "point_time",
        rate.alias("moer"),
        pounds_per_mwh_to_kg_per_kwh(rate).alias("moer_kgco2_per_kwh"),
        _or(F.col("p.percent"), 50).alias("percent"),
        _or(F.col("p.frequency"), 300).alias("frequency"),
        _or(F.col("p.market"), "RTM").alias("market"),
        (utc_now() if extracted_at is None else extracted_at).alias("extracted_at"),
    )
