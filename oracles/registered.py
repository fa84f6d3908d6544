"""Oracle text per registered query."""

from __future__ import annotations

from oracles.sql import SCOPES, cleanliness, oracle, wide_intensity

ORACLES: dict[str, tuple[str, str]] = {}


def add(name: str, query: str, doubles: str = "") -> None:
    ORACLES[name] = (query, doubles)


def oracle_sql(rounding: bool = True) -> dict[str, str]:
    return {name: oracle(query, doubles, rounding) for name, (query, doubles) in ORACLES.items()}


NATIVE = " ".join(SCOPES) + " total_kgco2e"

# --- ingest
add("ingest_gcp", """
SELECT id, account_id AS project_id, service_name AS service_description,
       region AS location_region, usage_month, scope1_kgco2e, scope2_location_based_kgco2e,
       scope2_market_based_kgco2e, scope3_kgco2e, total_kgco2e, extracted_at
FROM raw_native WHERE cloud_provider = 'GCP' AND usage_month >= DATE '1996-01-01'""", NATIVE)
for provider, key in (("AWS", "account_id"), ("Azure", "subscription_id")):
    add(f"ingest_{provider.lower()}", f"""
SELECT id, account_id AS {key}, service_name, region, usage_month, scope1_kgco2e,
       scope2_location_based_kgco2e, scope2_market_based_kgco2e, scope3_kgco2e, total_kgco2e
FROM raw_native WHERE cloud_provider = '{provider}'""", NATIVE)
add("ingest_ccf", "SELECT * EXCLUDE (extracted_at) FROM raw_ccf",
    "scope1_kgco2e scope2_kgco2e scope3_kgco2e total_kgco2e kilowatt_hours cost_usd")
GRID = ("carbon_intensity_gco2eq_per_kwh fossil_fuel_percentage renewable_percentage "
        "low_carbon_percentage")
add("ingest_grid_history", """
SELECT id, zone, ts AS timestamp, grams AS carbon_intensity_gco2eq_per_kwh,
       fossil AS fossil_fuel_percentage, renewable AS renewable_percentage,
       renewable AS low_carbon_percentage, mix AS power_production_breakdown,
       '{}' AS power_consumption_breakdown FROM raw_grid""", GRID)
add("ingest_moer", """
SELECT id, ba, ba AS ba_name, ts AS point_time, moer, moer_kg AS moer_kgco2_per_kwh,
       share AS percent, 300 AS frequency, 'RTM' AS market FROM raw_moer""",
    "moer moer_kgco2_per_kwh")

FEED_ROWS = {
    "gcp": ("usage_month", "raw_native WHERE cloud_provider = 'GCP'"),
    "aws": ("usage_month", "raw_native WHERE cloud_provider = 'AWS'"),
    "azure": ("usage_month", "raw_native WHERE cloud_provider = 'Azure'"),
    "ccf": ("usage_date", "raw_ccf WHERE TRUE"),
    "grid": ("ts", "raw_grid WHERE TRUE"),
    "moer": ("ts", "raw_moer WHERE TRUE"),
}
SHIPPED = "(SELECT max(l_shipdate)::DATE FROM lineitem)"
SEEN = "(SELECT max(ts) FROM events)"
FIRST = {
    "month": f"date_trunc('month', {SHIPPED} - 90)::DATE",
    "day": f"{SHIPPED} - 90",
    "hour": f"{SEEN} - INTERVAL 24 HOURS",
}
STEP = {"gcp": "", "aws": " + 1", "azure": " + 1", "ccf": " + 1",
        "grid": " + INTERVAL 1 HOUR", "moer": " + INTERVAL 5 MINUTES"}


def extent(feed: str, start: str) -> str:
    at, rows = FEED_ROWS[feed]
    end = f"{at} < date_trunc('month', {SHIPPED})::DATE" if feed in ("aws", "azure") else "TRUE"
    return f"""
SELECT '{feed}' AS feed, count(*) AS record_count, min({at})::TIMESTAMP AS first_at,
       max({at})::TIMESTAMP AS last_at FROM {rows} AND {at} >= {start} AND {end}"""


def unit(feed: str) -> str:
    return {"usage_month": "month", "usage_date": "day", "ts": "hour"}[FEED_ROWS[feed][0]]


def resume(feed: str) -> str:
    at, rows = FEED_ROWS[feed]
    mark = f"{SEEN} - INTERVAL 36 HOURS" if unit(feed) == "hour" else f"{SHIPPED} - 150"
    return f"(SELECT max({at}) FROM {rows} AND {at} <= {mark}){STEP[feed]}"


add("lookback_window", " UNION ALL ".join(extent(f, FIRST[unit(f)]) for f in FEED_ROWS))
add("incremental_since", " UNION ALL ".join(extent(f, resume(f)) for f in FEED_ROWS))
add("merge_upsert", f"""
SELECT * EXCLUDE (again)
       REPLACE (CASE WHEN again THEN extracted_at + INTERVAL 1 DAY ELSE extracted_at END AS extracted_at,
                CASE WHEN again THEN total_kgco2e * 1.1::DOUBLE ELSE total_kgco2e END AS total_kgco2e)
FROM (SELECT *, usage_month >= {SHIPPED} - 90 AS again FROM raw_native)""", NATIVE)
STATS = "avg_carbon_intensity min_carbon_intensity max_carbon_intensity avg_renewable_percentage"
add("seed_grid_regions", f"""
SELECT seed.*, stats.* EXCLUDE (grid_region),
       CASE WHEN stats.grid_region IS NOT NULL
            THEN {cleanliness('avg_carbon_intensity')} END AS cleanliness_category
FROM seed LEFT JOIN stats USING (grid_region)""", f"latitude longitude {STATS}")

# --- marts and exports
FACT = (NATIVE + " total_location_based_kgco2e total_mtco2e kilowatt_hours cost_usd "
        "kgco2e_per_dollar kgco2e_per_kwh")
for name in ("fact_cloud_carbon", "export_parquet"):
    add(name, "SELECT * FROM cloud_fact", FACT)
add("export_csv", "SELECT * FROM cloud_fact", FACT)
add("export_csv_limited", """
SELECT * FROM cloud_fact
ORDER BY usage_month_start, id, cloud_provider, account_id, service_name, region, total_kgco2e LIMIT 10000""", FACT)
add("export_csv_dump", """
SELECT 'fact_cloud_carbon' AS table_name, count(*) AS row_count, count(DISTINCT id) AS key_count,
       avg(total_kgco2e) AS measure_mean FROM cloud_fact
UNION ALL SELECT 'fact_grid_intensity', count(*), count(DISTINCT (grid_region, timestamp_hour, data_source)),
       avg(grams) FROM readings_fact
UNION ALL SELECT 'carbon_trends_monthly', count(*), count(DISTINCT (month, cloud_provider, account_id)),
       avg(total_kgco2e) FROM trends""", "measure_mean")
for provider, key in (("GCP", "project_id"), ("AWS", "account_id"), ("Azure", "account_id")):
    rename = "" if key == "account_id" else f" RENAME (account_id AS {key})"
    add(f"stg_{provider.lower()}",
        f"SELECT *{rename} FROM stg_native WHERE cloud_provider = '{provider}'",
        NATIVE + " total_market_based_kgco2e")
add("stg_ccf", "SELECT * FROM stg_ccf",
    "scope1_kgco2e scope2_kgco2e scope3_kgco2e total_kgco2e total_market_based_kgco2e "
    "total_kilowatt_hours total_cost_usd")
add("stg_grid", """
SELECT id, zone, ts AS timestamp, date_trunc('hour', ts) AS timestamp_hour,
       date_trunc('day', ts)::TIMESTAMP AS timestamp_day, grams AS carbon_intensity_gco2eq_per_kwh,
       grams / 1000 AS carbon_intensity_kgco2eq_per_kwh, fossil AS fossil_fuel_percentage,
       renewable AS renewable_percentage, renewable AS low_carbon_percentage,
       fossil AS high_carbon_percentage, mix AS power_production_breakdown,
       mix AS power_consumption_breakdown, 'Electricity Maps' AS data_source, ts AS extracted_at
FROM raw_grid WHERE grams > 0""",
    GRID + " carbon_intensity_kgco2eq_per_kwh high_carbon_percentage")
add("stg_moer", """
SELECT id, ba, ba AS ba_name, ts AS point_time, date_trunc('hour', ts) AS point_time_hour,
       date_trunc('day', ts)::TIMESTAMP AS point_time_day, moer, moer_kg AS moer_kgco2_per_kwh,
       share AS percent, 300 AS frequency, 'RTM' AS market, 'WattTime' AS data_source,
       ts AS extracted_at
FROM raw_moer WHERE moer > 0""", "moer moer_kgco2_per_kwh")
HOUR = "carbon_intensity_kgco2eq_per_kwh carbon_intensity_gco2eq_per_kwh"
UNITS = "(kilos AS carbon_intensity_kgco2eq_per_kwh, grams AS carbon_intensity_gco2eq_per_kwh)"
add("grid_hourly", f"SELECT * RENAME {UNITS} FROM hours_grid",
    HOUR + " fossil_fuel_percentage renewable_percentage")
add("moer_hourly", f"SELECT * RENAME {UNITS} FROM hours_moer", HOUR + " percentile_rank")
add("fact_grid_intensity", f"SELECT * RENAME {UNITS} FROM readings_fact",
    HOUR + " fossil_fuel_percentage renewable_percentage percentile_rank")
add("intensity_category", f"""
SELECT grid_region, timestamp_hour, data_source, intensity_category,
       {wide_intensity('grams')} AS wide_category, {cleanliness('grams')} AS cleanliness_category
FROM readings_fact""")
add("grid_intensity_daily", "SELECT * FROM daily", """
avg_carbon_intensity min_carbon_intensity max_carbon_intensity stddev_carbon_intensity daily_range
avg_fossil_fuel_percentage avg_renewable_percentage avg_peak_intensity avg_offpeak_intensity
peak_offpeak_delta""")
add("grid_daily_renamed", "SELECT * FROM daily_dash", """
avg_intensity min_intensity max_intensity stddev_intensity daily_range avg_fossil_percentage
avg_renewable_percentage avg_peak_intensity avg_offpeak_intensity peak_offpeak_delta""")
ROLLUP = "avg_intensity min_intensity max_intensity avg_fossil_percentage avg_renewable_percentage"
for period in ("day", "week", "month"):
    add(f"grid_rollup_{period}", f"SELECT * FROM by_{period}", ROLLUP)
add("region_stats", "SELECT * FROM stats", STATS)
add("region_metadata", "SELECT * FROM metadata")
add("dim_grid_regions", f"""
SELECT metadata.*, stats.* EXCLUDE (grid_region),
       {cleanliness('avg_carbon_intensity')} AS cleanliness_category, NULL::DOUBLE AS pue,
       NULL::DOUBLE AS wue, NULL::DOUBLE AS cfe_percent, NULL::VARCHAR AS grid_zone_id
FROM metadata JOIN stats USING (grid_region)""", STATS)
MONTH = ("total_kgco2e total_mtco2e scope1_kgco2e scope2_kgco2e scope3_kgco2e total_cost_usd "
         "total_kwh")
add("carbon_monthly", "SELECT * FROM months", MONTH)
add("carbon_trends", "SELECT * FROM trends ORDER BY month DESC, cloud_provider, account_id",
    MONTH + " scope1_percent scope2_percent scope3_percent kgco2e_per_dollar kgco2e_per_kwh "
    "prev_month_kgco2e mom_change_kgco2e mom_change_percent rolling_3mo_avg_kgco2e ytd_total_kgco2e")

# --- parametric
add("q_cloud", """
SELECT id, cloud_provider, account_id, service_name, region, usage_month_start, scope1_kgco2e,
       scope2_market_based_kgco2e, scope3_kgco2e, total_kgco2e, total_mtco2e, kgco2e_per_dollar,
       kgco2e_per_kwh, extracted_at
FROM cloud_fact
WHERE cloud_provider = 'GCP' AND service_name ILIKE '%o%'
  AND usage_month_start BETWEEN DATE '1996-01-01' AND DATE '2001-06-01'
ORDER BY usage_month_start DESC NULLS LAST, total_kgco2e DESC NULLS LAST, id LIMIT 5000""",
    "scope1_kgco2e scope2_market_based_kgco2e scope3_kgco2e total_kgco2e total_mtco2e "
    "kgco2e_per_dollar kgco2e_per_kwh")
TONNES = "total_mtco2e scope1_mtco2e scope2_mtco2e scope3_mtco2e"
BY_SCOPE = """sum(total_mtco2e) AS total_mtco2e, sum(scope1_kgco2e) / 1000 AS scope1_mtco2e,
       sum(scope2_market_based_kgco2e) / 1000 AS scope2_mtco2e,
       sum(scope3_kgco2e) / 1000 AS scope3_mtco2e,
       count(DISTINCT account_id) AS num_accounts, count(DISTINCT service_name) AS num_services"""
add("q_cloud_summary", f"""
SELECT cloud_provider, count(*) AS record_count, avg(total_mtco2e) AS avg_mtco2e, {BY_SCOPE},
       count(DISTINCT region) AS num_regions
FROM cloud_fact WHERE usage_month_start >= DATE '1996-01-01' GROUP BY cloud_provider""",
    TONNES + " avg_mtco2e")
GRID_ROW = HOUR + " fossil_fuel_percentage renewable_percentage"
add("q_grid", """
SELECT grid_region, timestamp_hour, grams AS carbon_intensity_gco2eq_per_kwh,
       kilos AS carbon_intensity_kgco2eq_per_kwh, fossil_fuel_percentage, renewable_percentage,
       intensity_category, data_source
FROM readings_fact
WHERE grid_region ILIKE '%o%'
  AND timestamp_hour BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25 12:00:00'
ORDER BY timestamp_hour DESC, grid_region, data_source LIMIT 2000""", GRID_ROW)
CURRENT = """grid_region, timestamp_hour, grams AS carbon_intensity_gco2eq_per_kwh,
       intensity_category, fossil_fuel_percentage, renewable_percentage, data_source"""
CURRENT_DOUBLES = "carbon_intensity_gco2eq_per_kwh fossil_fuel_percentage renewable_percentage"
add("q_grid_current", f"""
SELECT {CURRENT} FROM readings_fact
QUALIFY rank() OVER (PARTITION BY grid_region ORDER BY timestamp_hour DESC) = 1""", CURRENT_DOUBLES)
TREND = ("total_mtco2e scope1_percent scope2_percent scope3_percent mom_change_percent "
         "rolling_3mo_avg_mtco2e ytd_total_mtco2e")
add("q_trends", """
SELECT month, cloud_provider, account_id, total_mtco2e, scope1_percent, scope2_percent,
       scope3_percent, mom_change_percent, rolling_3mo_avg_mtco2e, ytd_total_mtco2e,
       trend_indicator, kgco2e_per_dollar
FROM trends_t WHERE cloud_provider = 'AWS'
ORDER BY month DESC, cloud_provider, account_id LIMIT 48""", TREND + " kgco2e_per_dollar")
add("q_sql", """
SELECT grid_region, count(*) AS hours_seen, avg(grams) AS avg_intensity
FROM readings_fact GROUP BY grid_region HAVING avg(grams) > 100""", "avg_intensity")

# --- dashboards
add("d_cloud_totals", f"SELECT cloud_provider, {BY_SCOPE} FROM cloud_fact GROUP BY 1", TONNES)
add("d_monthly_trend", """
SELECT usage_month_start, cloud_provider, sum(total_mtco2e) AS total_mtco2e
FROM cloud_fact GROUP BY ALL""", "total_mtco2e")
add("d_scope_breakdown", """
SELECT 'Scope 1' AS scope, sum(scope1_kgco2e) / 1000 AS mtco2e FROM cloud_fact
UNION ALL
SELECT 'Scope 2 (Market-Based)', sum(scope2_market_based_kgco2e) / 1000 FROM cloud_fact
UNION ALL
SELECT 'Scope 3', sum(scope3_kgco2e) / 1000 FROM cloud_fact""", "mtco2e")
add("d_trends", """
SELECT month, cloud_provider, account_id, total_mtco2e, mom_change_percent,
       rolling_3mo_avg_mtco2e, ytd_total_mtco2e, trend_indicator, scope1_percent, scope2_percent,
       scope3_percent
FROM trends_t ORDER BY month DESC, cloud_provider, account_id LIMIT 100""", TREND)
add("d_mom_change", """
SELECT month, cloud_provider, mom_change_percent FROM trends_t
WHERE mom_change_percent IS NOT NULL""", "mom_change_percent")
add("d_ytd", "SELECT month, cloud_provider, ytd_total_mtco2e FROM trends_t", "ytd_total_mtco2e")
add("d_dc_emissions", """
SELECT cloud_provider, region AS datacenter_region, service_name,
       sum(total_mtco2e) AS total_emissions_mtco2e,
       count(DISTINCT usage_month_start) AS months_of_data,
       avg(total_mtco2e) AS avg_monthly_emissions
FROM cloud_fact WHERE region IS NOT NULL GROUP BY ALL""",
    "total_emissions_mtco2e avg_monthly_emissions")
add("d_dc_totals", """
SELECT cloud_provider, region AS datacenter_region, sum(total_mtco2e) AS total_emissions_mtco2e,
       count(DISTINCT service_name) AS num_services
FROM cloud_fact WHERE region IS NOT NULL GROUP BY ALL""", "total_emissions_mtco2e")
add("d_dc_mapping", """
SELECT grid_region, region_name AS grid_region_name, country, cloud_providers, gcp_regions,
       aws_regions, azure_regions, latitude, longitude
FROM dim WHERE cloud_providers IS NOT NULL""", "latitude longitude")
MAPPED = "grid_avg_intensity total_emissions_mtco2e"
add("datacenter_with_grid", "SELECT * FROM with_grid", MAPPED + " latitude longitude")
add("d_dc_map", """
SELECT cloud_provider, datacenter_region, grid_region_name, grid_avg_intensity,
       total_emissions_mtco2e, latitude AS lat, longitude AS long
FROM with_grid WHERE total_emissions_mtco2e > 0""", MAPPED + " lat long")
add("d_cleanest", """
SELECT * EXCLUDE (grid_region, latitude, longitude)
FROM (SELECT * FROM with_grid WHERE total_emissions_mtco2e > 0
      ORDER BY grid_avg_intensity ASC NULLS LAST, cloud_provider, datacenter_region, grid_region
      LIMIT 10)""", MAPPED)
add("d_current_24h", f"""
SELECT {CURRENT} FROM readings_fact, newest WHERE timestamp_hour >= last_hour - INTERVAL 1 DAY""",
    CURRENT_DOUBLES)
add("d_trend_7d", """
SELECT timestamp_hour, grid_region, grams AS carbon_intensity_gco2eq_per_kwh
FROM readings_fact, newest WHERE timestamp_hour >= last_hour - INTERVAL 7 DAYS""",
    "carbon_intensity_gco2eq_per_kwh")
add("d_by_category", """
SELECT intensity_category, count(*) AS count, avg(grams) AS avg_intensity
FROM readings_fact, newest WHERE timestamp_hour >= last_hour - INTERVAL 7 DAYS GROUP BY 1""",
    "avg_intensity")
add("d_map", """
SELECT f.grid_region, d.region_name, d.city, d.country, d.cloud_providers,
       avg(grams) AS avg_intensity, avg(fossil_fuel_percentage) AS avg_fossil,
       avg(renewable_percentage) AS avg_renewable, d.latitude AS lat, d.longitude AS long
FROM newest, readings_fact f JOIN dim d ON d.grid_region = f.grid_region
WHERE timestamp_hour >= last_hour - INTERVAL 1 DAY
GROUP BY ALL""", "avg_intensity avg_fossil avg_renewable lat long")
add("d_daily_avg", """
SELECT date, grid_region, region_name, country, avg_intensity, avg_fossil_percentage,
       avg_renewable_percentage
FROM last_week JOIN dim USING (grid_region)""",
    "avg_intensity avg_fossil_percentage avg_renewable_percentage")
add("d_weekly_cmp", """
SELECT grid_region, region_name, country, avg(avg_intensity) AS avg_intensity,
       avg(avg_fossil_percentage) AS avg_fossil, avg(avg_renewable_percentage) AS avg_renewable,
       min(w.avg_intensity) AS min_intensity, max(w.avg_intensity) AS max_intensity
FROM last_week w JOIN dim USING (grid_region)
GROUP BY grid_region, region_name, country ORDER BY avg(w.avg_intensity), grid_region LIMIT 20""",
    "avg_intensity avg_fossil avg_renewable min_intensity max_intensity")
add("d_monthly_regional", """
SELECT month_start, grid_region, region_name, country, avg_intensity, avg_fossil_percentage,
       avg_renewable_percentage
FROM by_month JOIN dim USING (grid_region)""",
    "avg_intensity avg_fossil_percentage avg_renewable_percentage")

# --- streaming
POINTS = """(SELECT * FROM raw_moer
  QUALIFY row_number() OVER (PARTITION BY ba, ts ORDER BY moer DESC, share DESC) = 1)"""
add("stream_hourly", f"""
SELECT ba AS grid_region, date_trunc('hour', ts) AS timestamp_hour, 'WattTime' AS data_source,
       avg(moer_kg) AS carbon_intensity_kgco2eq_per_kwh,
       avg(moer_kg * 1000) AS carbon_intensity_gco2eq_per_kwh, avg(share) AS percentile_rank,
       sum(moer_kg) AS sum_kgco2_per_kwh, count(*) AS points, max(ts) AS extracted_at
FROM {POINTS} WHERE moer > 0 GROUP BY 1, 2""",
    HOUR + " percentile_rank sum_kgco2_per_kwh")
add("stream_corrected", f"""
SELECT ba AS grid_region, date_trunc('hour', ts) AS timestamp_hour, 'WattTime' AS data_source,
       avg(moer_kg) AS carbon_intensity_kgco2eq_per_kwh,
       avg(moer_kg * 1000) AS carbon_intensity_gco2eq_per_kwh, avg(share) AS percentile_rank,
       sum(moer_kg) AS sum_kgco2_per_kwh, count(*) AS points, max(ts) AS extracted_at
FROM {POINTS} WHERE moer > 0 AND hour(ts) % 3 <> 0 GROUP BY 1, 2""",
    HOUR + " percentile_rank sum_kgco2_per_kwh")
add("refresh_touched", """
SELECT cloud_provider, account_id, service_name, region, usage_month_start, factor * scope1_kgco2e AS scope1_kgco2e,
       factor * scope3_kgco2e AS scope3_kgco2e, factor * total_market_based_kgco2e AS total_kgco2e,
       factor * total_market_based_kgco2e / 1000 AS total_mtco2e
FROM (SELECT *, CASE month(usage_month) % 4 WHEN 1 THEN 2 ELSE 1 END AS factor FROM stg_native
      WHERE cloud_provider = 'AWS' AND month(usage_month) % 4 <> 0)""",
    "scope1_kgco2e scope3_kgco2e total_kgco2e total_mtco2e")
add("load_late", f"""
SELECT id, ba, ba AS ba_name, ts AS point_time, moer, moer_kg AS moer_kgco2_per_kwh,
       share AS percent, 300 AS frequency, 'RTM' AS market FROM {POINTS}""",
    "moer moer_kgco2_per_kwh")
add("stream_upsert", """
SELECT id, ba, ba AS ba_name, ts AS point_time, moer, moer_kg AS moer_kgco2_per_kwh,
       share AS percent, 300 AS frequency, 'RTM' AS market, ts AS extracted_at,
       ts::DATE AS point_day
FROM raw_moer
QUALIFY row_number() OVER (PARTITION BY ba, ts ORDER BY moer DESC, share DESC) = 1""",
    "moer moer_kgco2_per_kwh")

# --- data quality
def nulls(table: str, source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{shown}' AS column_name, "
        f"count(*) FILTER ({real} IS NULL) AS null_count FROM {source}"
        for shown, real in columns.items()
    )


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


add("dq_not_null", " UNION ALL ".join([
    nulls("grid_intensity_daily", "daily",
          same("grid_region", "timestamp_day", "avg_carbon_intensity", "distinct_hours",
               "stddev_carbon_intensity")),
    nulls("raw_grid", "raw_grid", {"id": "id", "timestamp": "ts"}),
    nulls("raw_moer", "raw_moer", {"id": "id", "point_time": "ts"}),
    nulls("raw_native", "raw_native", same("id", "usage_month", "total_kgco2e")),
    nulls("raw_ccf", "raw_ccf", same("id", "usage_date")),
]))
add("dq_unique", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS duplicate_value, "
    f"count(*) AS occurrences FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
    "HAVING count(*) > 1"
    for table, source, column in (
        ("fact_cloud_carbon", "cloud_fact", "id"), ("raw_ccf", "raw_ccf", "id"),
        ("raw_grid", "raw_grid", "id"), ("dim_grid_regions", "dim", "grid_region"))
))
def suite(table: str, source: str, present: dict[str, str], single: dict[str, str]) -> str:
    """``present`` and ``single`` give the shown column and its name or expression here."""
    parts = [
        f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{shown}' AS column_name, "
        f"count(*) FILTER ({real} IS NULL) AS failures FROM {source}"
        for shown, real in present.items()
    ] + [
        f"SELECT '{table}', 'unique', '{shown}', count({real}) - count(DISTINCT {real}) FROM {source}"
        for shown, real in single.items()
    ]
    return " UNION ALL ".join(parts)


NATIVE_OF = {"gcp": "GCP", "aws": "AWS", "azure": "Azure"}
add("dq_suite", " UNION ALL ".join([
    *[suite(f"raw_{f}", f"(FROM raw_native WHERE cloud_provider = '{p}')", same("id", "usage_month"), same("id"))
      for f, p in NATIVE_OF.items()],
    suite("raw_ccf", "raw_ccf", same("id", "usage_date"), same("id")),
    suite("raw_grid", "raw_grid", {"id": "id", "timestamp": "ts"}, same("id")),
    suite("raw_moer", "raw_moer", {"id": "id", "point_time": "ts"}, same("id")),
    *[suite(f"stg_{f}", f"(FROM stg_native WHERE cloud_provider = '{p}')", same("id"), same("id"))
      for f, p in NATIVE_OF.items()],
    suite("stg_ccf", "stg_ccf", same("id"), same("id")),
    suite("stg_grid", "(FROM raw_grid WHERE grams > 0)", same("id"), same("id")),
    suite("stg_moer", "(FROM raw_moer WHERE moer > 0)", same("id"), same("id")),
    suite("fact_cloud_carbon", "cloud_fact", same("id"), same("id")),
    suite("carbon_trends_monthly", "trends", same("month", "cloud_provider"), {}),
    suite("fact_grid_intensity", "readings_fact", same("grid_region", "timestamp_hour"), {}),
    suite("grid_intensity_daily", "daily", same("grid_region", "timestamp_day", "avg_carbon_intensity"), {}),
    suite("dim_grid_regions", "dim", same("grid_region"), same("grid_region")),
]))
RULES = {
    "avg_carbon_intensity >= 0": "avg_carbon_intensity >= 0",
    "distinct_hours <= 24": "distinct_hours <= 24",
    "is_complete_day": "is_complete_day",
    "stddev < 100": "stddev_carbon_intensity < 100",
}
add("dq_expression", " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (NOT ({test})) AS false_count, "
    f"count(*) FILTER (({test}) IS NULL) AS null_count FROM daily"
    for name, test in RULES.items()
))
add("dq_violations", """
SELECT grid_region, timestamp_day,
       concat_ws(',', CASE WHEN NOT is_complete_day THEN 'is_complete_day' END,
                 CASE WHEN NOT stddev_carbon_intensity < 100 THEN 'stddev < 100' END) AS failed_rules
FROM daily WHERE NOT is_complete_day OR NOT stddev_carbon_intensity < 100""")
MISSING = ("date, avg_intensity, min_intensity, max_intensity, avg_fossil_percentage")
add("dq_schema", f"""
SELECT table_name, row_count, missing_columns,
       CASE WHEN missing_columns <> '' THEN 'error' WHEN row_count = 0 THEN 'warning'
            ELSE 'ok' END AS status
FROM (SELECT 'fact_grid_intensity' AS table_name, count(*) AS row_count, '' AS missing_columns
      FROM readings_fact
      UNION ALL SELECT 'fact_cloud_carbon', count(*), '' FROM cloud_fact
      UNION ALL SELECT 'grid_intensity_daily', count(*), '{MISSING}' FROM daily
      UNION ALL SELECT 'dim_grid_regions', count(*), '' FROM dim
      UNION ALL SELECT 'carbon_trends_monthly', count(*), '' FROM trends)""")


def outside(label: str, limits: tuple[int, int, int]) -> str:
    columns = ("scope1_kgco2e", "scope2_market_based_kgco2e", "scope3_kgco2e")
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER ({c} < 0 OR {c} > {top}) AS out_of_range FROM cloud_fact"
        for c, top in zip(columns, limits)
    )


add("dq_range", outside("declared limits", (10**6, 10**7, 5 * 10**7)) + " UNION ALL "
    + outside("tight limits", (100, 2000, 300)))
add("dq_freshness", """
SELECT cloud_provider, max(usage_month_start) AS latest,
       date_diff('day', max(usage_month_start), DATE '2002-01-15') AS age_days,
       date_diff('day', max(usage_month_start), DATE '2002-01-15') <= 90 AS is_fresh
FROM cloud_fact GROUP BY cloud_provider""")
