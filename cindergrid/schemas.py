"""Input schemas as Spark DDL, and the column contracts of the derived tables.

Landing JSON is never inferred: inference costs a full extra pass and drifts between loads.
"""

from __future__ import annotations

# Landed records, one JSON object per line (the nested table export is read typed).
LANDED = {
    "gcp": (
        "project struct<id:string>, service struct<description:string>, "
        "location struct<region:string>, usage_month date, "
        "carbon_footprint_kgCO2e struct<scope1:double, "
        "scope2:struct<location_based:double, market_based:double>, scope3:double>"
    ),
    "tonnes": (
        "AccountId string, Month string, ServiceName string, Region string, Scope1 double, "
        "Scope2LocationBased double, Scope2MarketBased double, Scope3 double"
    ),
    "ccf": (
        "timestamp string, serviceEstimates array<struct<cloudProvider:string, accountId:string, "
        "accountName:string, serviceName:string, region:string, kilowattHours:double, "
        "scope1:double, scope2:double, scope3:double, cost:double>>"
    ),
    "grid": (
        "zone string, history array<struct<datetime:string, carbonIntensity:double, "
        "fossilFuelPercentage:double, renewablePercentage:double, lowCarbonPercentage:double, "
        "powerProductionBreakdown:map<string,double>, "
        "powerConsumptionBreakdown:map<string,double>>>"
    ),
    "moer": (
        "ba string, data array<struct<point_time:string, value:double, ba_name:string, "
        "percent:int, frequency:int, market:string>>"
    ),
}

CORRUPT = "_corrupt_record"

# Natural keys of the raw tables, used by the upsert.
NATURAL_KEYS = {
    "gcp": ["project_id", "service_description", "location_region", "usage_month"],
    "aws": ["account_id", "service_name", "region", "usage_month"],
    "azure": ["subscription_id", "service_name", "region", "usage_month"],
    "ccf": ["cloud_provider", "account_id", "service_name", "region", "usage_date"],
    "grid": ["zone", "timestamp"],
    "moer": ["ba", "point_time"],
}

# Partition column of the stored raw tables: the month of the time key, or its day for the
# feeds of hours, so that a late batch rewrites days and not months.
RAW_PERIOD = "load_period"

# Columns each table must have before dashboards may read it.
REQUIRED_COLUMNS = {
    "fact_grid_intensity": [
        "grid_region", "timestamp_hour", "carbon_intensity_gco2eq_per_kwh",
        "renewable_percentage", "fossil_fuel_percentage",
    ],
    "fact_cloud_carbon": ["cloud_provider", "usage_month_start", "total_mtco2e", "region"],
    "grid_intensity_daily": [
        "grid_region", "date", "avg_intensity", "min_intensity", "max_intensity",
        "avg_fossil_percentage", "avg_renewable_percentage",
    ],
    "dim_grid_regions": ["grid_region", "region_name", "country", "latitude", "longitude"],
    "carbon_trends_monthly": ["month", "cloud_provider", "total_mtco2e"],
}
