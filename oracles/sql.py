"""The oracle texts. ``oracle()`` puts the common table expressions a query needs in front of it."""

from __future__ import annotations

import re

from cindergrid.sources.testbed import ZONES
from oracles.expected import ATTRIBUTES, RULES, SEED, SEED_COLUMNS
from oracles.precision import digits, shift


def text(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def scale(value: str, bounds: list[int], labels: str) -> str:
    names = labels.split(", ")
    steps = " ".join(f"WHEN {value} < {b} THEN '{n}'" for b, n in zip(bounds, names))
    return f"CASE {steps} ELSE '{names[-1]}' END"


def intensity(value: str) -> str:
    return scale(value, [100, 250, 400, 600], "Very Low, Low, Medium, High, Very High")


def wide_intensity(value: str) -> str:
    return scale(value, [100, 300, 500, 700], "Very Low, Low, Medium, High, Very High")


def cleanliness(value: str) -> str:
    return scale(value, [150, 300, 450, 600], "Very Clean, Clean, Medium, Dirty, Very Dirty")


def share(part: str) -> str:
    return f"CASE WHEN total_kgco2e > 0 THEN {part} / total_kgco2e * 100 ELSE 0 END"


def guarded(numerator: str, denominator: str) -> str:
    return f"CASE WHEN {denominator} > 0 THEN {numerator} / {denominator} END"


ZONE_LIST = "[" + ", ".join(text(z) for z in ZONES) + "]"
ISO = "replace(strftime({0}, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || '+00:00'"
SCOPES = ("scope1_kgco2e", "scope2_location_based_kgco2e", "scope2_market_based_kgco2e", "scope3_kgco2e")
SUM_SCOPES = ", ".join(f"sum({s}) AS {s}" for s in SCOPES)

_rule_rows = ",\n".join(
    "(" + ", ".join([str(i), text(code), *[text(values.get(a)) for a in ATTRIBUTES]]) + ")"
    for i, (codes, values) in enumerate(RULES)
    for code in codes
)
_first = "\n".join(
    f", arg_min(rule.{a}, rule.pos) FILTER (rule.{a} IS NOT NULL) AS {a}" for a in ATTRIBUTES
)
_seed_rows = ",\n".join("(" + ", ".join(text(v) for v in row) + ")" for row in SEED)
_seed_names = ", ".join(SEED_COLUMNS)


def rollup(unit: str, period: str) -> str:
    return f"""
SELECT grid_region, date_trunc('{unit}', timestamp_day)::DATE AS {period},
       avg(grams) AS avg_intensity, min(grams) AS min_intensity, max(grams) AS max_intensity,
       avg(fossil_fuel_percentage) AS avg_fossil_percentage,
       avg(renewable_percentage) AS avg_renewable_percentage, count(*) AS readings_count
FROM readings_fact GROUP BY ALL"""


CTES = {
    # emissions
    "lines": """
SELECT f.provider AS cloud_provider, lower(f.provider) || '-' || o_orderpriority AS account_id,
       p_type AS service_name, n_name AS region, l_shipdate::DATE AS usage_date,
       l_linestatus AS feed, l_quantity AS scope1_kgco2e,
       l_extendedprice / 100 AS scope2_location_based_kgco2e,
       l_extendedprice * (1 - l_discount) / 100 AS scope2_market_based_kgco2e,
       l_tax * 1000 AS scope3_kgco2e, l_quantity * 10 AS kilowatt_hours,
       l_extendedprice AS cost_usd, l_shipdate AS extracted_at
FROM lineitem
LEFT JOIN (VALUES ('A', 'AWS'), ('N', 'GCP'), ('R', 'Azure')) AS f(flag, provider)
       ON flag = l_returnflag
JOIN orders ON o_orderkey = l_orderkey
JOIN part ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey""",
    "raw_native": f"""
SELECT *, account_id || '_' || service_name || '_' || region || '_' ||
       left(usage_month::VARCHAR, CASE cloud_provider WHEN 'GCP' THEN 7 ELSE 10 END) AS id,
       scope1_kgco2e + scope2_location_based_kgco2e + scope3_kgco2e AS total_kgco2e
FROM (SELECT cloud_provider, account_id, service_name, region,
             date_trunc('month', usage_date)::DATE AS usage_month, {SUM_SCOPES},
             max(extracted_at) AS extracted_at
      FROM lines WHERE feed = 'F' GROUP BY ALL)""",
    "stg_native": """
SELECT *, usage_month AS usage_month_start,
       scope1_kgco2e + scope2_market_based_kgco2e + scope3_kgco2e AS total_market_based_kgco2e
FROM raw_native WHERE total_kgco2e > 0""",
    "raw_ccf": """
SELECT cloud_provider || '_' || account_id || '_' || service_name || '_' || region || '_' ||
       usage_date::VARCHAR AS id, cloud_provider, account_id, service_name, region, usage_date,
       scope1_kgco2e, scope2_location_based_kgco2e AS scope2_kgco2e, scope3_kgco2e,
       scope1_kgco2e + scope2_location_based_kgco2e + scope3_kgco2e AS total_kgco2e,
       kilowatt_hours, cost_usd, extracted_at
FROM lines WHERE feed = 'O'""",
    "stg_ccf": """
SELECT concat_ws('_', cloud_provider, account_id, service_name, region,
                 strftime(usage_month_start, '%Y-%m')) AS id, *
FROM (SELECT cloud_provider, account_id, service_name, region,
             date_trunc('month', usage_date)::DATE AS usage_month_start,
             sum(scope1_kgco2e) AS scope1_kgco2e, sum(scope2_kgco2e) AS scope2_kgco2e,
             sum(scope3_kgco2e) AS scope3_kgco2e, sum(total_kgco2e) AS total_kgco2e,
             sum(scope1_kgco2e + scope2_kgco2e + scope3_kgco2e) AS total_market_based_kgco2e,
             sum(kilowatt_hours) AS total_kilowatt_hours, sum(cost_usd) AS total_cost_usd,
             max(extracted_at) AS extracted_at
      FROM raw_ccf WHERE total_kgco2e > 0 GROUP BY ALL)""",
    "cloud_fact": f"""
SELECT id, cloud_provider, account_id, service_name, region, usage_month_start,
       scope1_kgco2e, scope2_location_based_kgco2e, scope2_market_based_kgco2e, scope3_kgco2e,
       market AS total_kgco2e,
       scope1_kgco2e + scope2_location_based_kgco2e + scope3_kgco2e AS total_location_based_kgco2e,
       market / 1000 AS total_mtco2e, kilowatt_hours, cost_usd,
       {guarded('market', 'cost_usd')} AS kgco2e_per_dollar,
       {guarded('market', 'kilowatt_hours')} AS kgco2e_per_kwh, extracted_at
FROM (SELECT id, cloud_provider, account_id, service_name, region, usage_month_start,
             scope1_kgco2e, scope2_location_based_kgco2e, scope2_market_based_kgco2e,
             scope3_kgco2e, total_market_based_kgco2e AS market,
             NULL::DOUBLE AS kilowatt_hours, NULL::DOUBLE AS cost_usd, extracted_at
      FROM stg_native
      UNION ALL BY NAME
      SELECT id, cloud_provider, account_id, service_name, region, usage_month_start,
             scope1_kgco2e, scope2_kgco2e AS scope2_location_based_kgco2e,
             scope2_kgco2e AS scope2_market_based_kgco2e, scope3_kgco2e,
             total_market_based_kgco2e AS market, total_kilowatt_hours AS kilowatt_hours,
             total_cost_usd AS cost_usd, extracted_at
      FROM stg_ccf)""",
    "months": """
SELECT usage_month_start AS month, cloud_provider, account_id,
       sum(total_kgco2e) AS total_kgco2e, sum(total_mtco2e) AS total_mtco2e,
       sum(scope1_kgco2e) AS scope1_kgco2e, sum(scope2_market_based_kgco2e) AS scope2_kgco2e,
       sum(scope3_kgco2e) AS scope3_kgco2e, sum(cost_usd) AS total_cost_usd,
       sum(kilowatt_hours) AS total_kwh, count(DISTINCT service_name) AS num_services,
       count(DISTINCT region) AS num_regions
FROM cloud_fact GROUP BY ALL""",
    "trends": f"""
SELECT month, cloud_provider, account_id, total_kgco2e, total_mtco2e,
       scope1_kgco2e, scope2_kgco2e, scope3_kgco2e,
       {share('scope1_kgco2e')} AS scope1_percent, {share('scope2_kgco2e')} AS scope2_percent,
       {share('scope3_kgco2e')} AS scope3_percent, total_cost_usd, total_kwh,
       {guarded('total_kgco2e', 'total_cost_usd')} AS kgco2e_per_dollar,
       {guarded('total_kgco2e', 'total_kwh')} AS kgco2e_per_kwh, num_services, num_regions,
       before AS prev_month_kgco2e, total_kgco2e - before AS mom_change_kgco2e,
       change AS mom_change_percent, rolling_3mo_avg_kgco2e, ytd_total_kgco2e,
       CASE WHEN change IS NULL THEN 'New Account' WHEN change > 10 THEN 'Increasing ⬆'
            WHEN change < -10 THEN 'Decreasing ⬇' ELSE 'Stable ⏸' END AS trend_indicator
FROM (SELECT *, {guarded('(total_kgco2e - before)', 'before')} * 100 AS change
      FROM (SELECT m.*, prior.total_kgco2e AS before,
                   (SELECT avg(total_kgco2e) FROM numbered r
                    WHERE r.cloud_provider = m.cloud_provider AND r.account_id = m.account_id
                      AND r.pos BETWEEN m.pos - 2 AND m.pos) AS rolling_3mo_avg_kgco2e,
                   (SELECT sum(total_kgco2e) FROM numbered y
                    WHERE y.cloud_provider = m.cloud_provider AND y.account_id = m.account_id
                      AND year(y.month) = year(m.month) AND y.month <= m.month) AS ytd_total_kgco2e
            FROM numbered m
            LEFT JOIN numbered prior
                   ON prior.cloud_provider = m.cloud_provider
                  AND prior.account_id = m.account_id AND prior.pos = m.pos - 1))""",
    "numbered": """
SELECT *, row_number() OVER (PARTITION BY cloud_provider, account_id ORDER BY month) AS pos
FROM months""",
    "trends_t": """
SELECT *, rolling_3mo_avg_kgco2e / 1000 AS rolling_3mo_avg_mtco2e,
       ytd_total_kgco2e / 1000 AS ytd_total_mtco2e
FROM trends""",
    # grid
    "readings": f"""
SELECT {ZONE_LIST}[(user_id % 12 + 1)::INTEGER] AS zone, ts, event_type,
       value * (1 + user_id % 12) * 1.1::DOUBLE AS grams,
       regexp_extract(props, '[0-9]+')::INTEGER AS share
FROM events""",
    "raw_grid": f"""
SELECT zone || '_' || {ISO.format('ts')} AS id, zone, ts,
       grams, share::DOUBLE AS fossil, (100 - share)::DOUBLE AS renewable,
       '{{"fossil":' || share::DOUBLE::VARCHAR || ',"renewable":' ||
       (100 - share)::DOUBLE::VARCHAR || '}}' AS mix
FROM readings WHERE event_type IN ('view', 'click', 'purchase')""",
    "raw_moer": f"""
SELECT zone || '_' || {ISO.format('ts')} AS id, zone AS ba, ts, share,
       grams / 0.453592::DOUBLE AS moer,
       grams / 0.453592::DOUBLE * 0.453592::DOUBLE / 1000 AS moer_kg
FROM readings WHERE event_type IN ('signup', 'error')""",
    "hours_grid": """
SELECT zone AS grid_region, date_trunc('hour', ts) AS timestamp_hour,
       date_trunc('day', ts)::TIMESTAMP AS timestamp_day, 'Electricity Maps' AS data_source,
       avg(grams / 1000) AS kilos, avg(grams) AS grams, avg(fossil) AS fossil_fuel_percentage,
       avg(renewable) AS renewable_percentage, max(ts) AS extracted_at
FROM raw_grid WHERE grams > 0 GROUP BY ALL""",
    "hours_moer": """
SELECT ba AS grid_region, date_trunc('hour', ts) AS timestamp_hour,
       date_trunc('day', ts)::TIMESTAMP AS timestamp_day, 'WattTime' AS data_source,
       avg(moer_kg) AS kilos, avg(moer_kg * 1000) AS grams, avg(share) AS percentile_rank,
       max(ts) AS extracted_at
FROM raw_moer WHERE moer > 0 GROUP BY ALL""",
    "readings_fact": f"""
SELECT *, {intensity('grams')} AS intensity_category,
       date_trunc('week', timestamp_day)::TIMESTAMP AS timestamp_week,
       date_trunc('month', timestamp_day)::TIMESTAMP AS timestamp_month
FROM (SELECT * FROM hours_grid UNION ALL BY NAME SELECT * FROM hours_moer)""",
    "daily": f"""
SELECT grid_region, timestamp_day, timestamp_week, timestamp_month,
       year(timestamp_day)::BIGINT AS year, month(timestamp_day)::BIGINT AS month,
       dayofweek(timestamp_day)::BIGINT AS day_of_week,
       avg(grams) AS avg_carbon_intensity, min(grams) AS min_carbon_intensity,
       max(grams) AS max_carbon_intensity, stddev_samp(grams) AS stddev_carbon_intensity,
       max(grams) - min(grams) AS daily_range,
       {intensity('avg(grams)')} AS avg_intensity_category,
       avg(fossil_fuel_percentage) AS avg_fossil_fuel_percentage,
       avg(renewable_percentage) AS avg_renewable_percentage,
       count(*) AS hours_reported, count(DISTINCT timestamp_hour) AS distinct_hours,
       count(*) FILTER (grams < 250) AS low_carbon_hours,
       count(*) FILTER (grams >= 600) AS high_carbon_hours,
       count(DISTINCT timestamp_hour) >= 20 AS is_complete_day,
       avg(grams) FILTER (hour(timestamp_hour) BETWEEN 7 AND 22) AS avg_peak_intensity,
       avg(grams) FILTER (hour(timestamp_hour) NOT BETWEEN 7 AND 22) AS avg_offpeak_intensity,
       avg(grams) FILTER (hour(timestamp_hour) BETWEEN 7 AND 22) -
       avg(grams) FILTER (hour(timestamp_hour) NOT BETWEEN 7 AND 22) AS peak_offpeak_delta,
       count(DISTINCT data_source) AS num_data_sources, max(extracted_at) AS last_extracted_at
FROM readings_fact GROUP BY grid_region, timestamp_day, timestamp_week, timestamp_month""",
    "daily_dash": """
SELECT grid_region, timestamp_day::DATE AS date, timestamp_week, timestamp_month, year, month,
       day_of_week, avg_carbon_intensity AS avg_intensity, min_carbon_intensity AS min_intensity,
       max_carbon_intensity AS max_intensity, stddev_carbon_intensity AS stddev_intensity,
       daily_range, avg_intensity_category, avg_fossil_fuel_percentage AS avg_fossil_percentage,
       avg_renewable_percentage, hours_reported, distinct_hours, low_carbon_hours,
       high_carbon_hours, is_complete_day, avg_peak_intensity, avg_offpeak_intensity,
       peak_offpeak_delta, num_data_sources
FROM daily""",
    "by_day": rollup("day", "date"),
    "by_week": rollup("week", "week_start"),
    "by_month": rollup("month", "month_start"),
    "stats": """
SELECT grid_region, min(timestamp_day) AS first_data_date, max(timestamp_day) AS last_data_date,
       count(DISTINCT timestamp_day) AS days_of_data, avg(grams) AS avg_carbon_intensity,
       min(grams) AS min_carbon_intensity, max(grams) AS max_carbon_intensity,
       avg(renewable_percentage) AS avg_renewable_percentage
FROM readings_fact GROUP BY grid_region""",
    "rule": f"""
SELECT * FROM (VALUES
{_rule_rows}) AS t(pos, code, {', '.join(ATTRIBUTES)})""",
    "metadata": f"""
SELECT grid_region, coalesce(region_name, grid_region) AS region_name,
       coalesce(country, 'Unknown') AS country, coalesce(continent, 'Other') AS continent,
       timezone, coalesce(region_type, 'Grid Zone') AS region_type
FROM (SELECT s.grid_region {_first}
      FROM (SELECT DISTINCT grid_region FROM readings_fact) s
      LEFT JOIN rule ON s.grid_region LIKE rule.code GROUP BY s.grid_region)""",
    "seed": f"""
SELECT * FROM (VALUES
{_seed_rows}) AS t({_seed_names})""",
    "dim": f"""
SELECT CASE WHEN k < 12 THEN {ZONE_LIST}[(k % 12 + 1)::INTEGER] ELSE 'ZONE-' || k END AS grid_region,
       n_name AS region_name, 'City ' || k AS city, r_name AS country,
       (k * 3 - 30)::DOUBLE AS latitude, (k * 7 - 80)::DOUBLE AS longitude,
       ['GCP, AWS, Azure', 'GCP, Azure', 'AWS'][(k % 3 + 1)::INTEGER] AS cloud_providers,
       CASE WHEN k % 3 <> 2 THEN pair ELSE '' END AS gcp_regions,
       CASE WHEN k % 3 <> 1 THEN pair ELSE '' END AS aws_regions,
       CASE WHEN k % 3 <> 2 THEN pair ELSE '' END AS azure_regions
FROM (SELECT *, n_nationkey AS k,
             'NATION_' || n_nationkey || ', NATION_' || (n_nationkey + 12) AS pair
      FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "mapped": """
SELECT grid_region, region_name, country, latitude, longitude, provider,
       trim(unnest(string_split(regions, ','))) AS datacenter_region
FROM (SELECT *, 'GCP' AS provider, gcp_regions AS regions FROM dim
      UNION ALL SELECT *, 'AWS', aws_regions FROM dim
      UNION ALL SELECT *, 'Azure', azure_regions FROM dim)
WHERE position(provider IN cloud_providers) > 0""",
    "with_grid": f"""
SELECT provider AS cloud_provider, datacenter_region, m.grid_region,
       region_name AS grid_region_name, country, i.mean AS grid_avg_intensity,
       CASE WHEN i.grid_region IS NOT NULL THEN {intensity('i.mean')} END AS cleanliness_category,
       coalesce(e.tonnes, 0) AS total_emissions_mtco2e, latitude, longitude
FROM mapped m
LEFT JOIN (SELECT grid_region, avg(avg_carbon_intensity) AS mean FROM daily GROUP BY 1) i
       ON i.grid_region = m.grid_region
LEFT JOIN (SELECT cloud_provider, region, sum(total_mtco2e) AS tonnes FROM cloud_fact
           WHERE region IS NOT NULL GROUP BY 1, 2) e
       ON e.cloud_provider = provider AND e.region = datacenter_region
WHERE datacenter_region <> ''""",
    "newest": "SELECT max(timestamp_hour) AS last_hour FROM readings_fact",
    "last_week": """
SELECT * FROM daily_dash WHERE date >= (SELECT max(date) FROM daily_dash) - 7""",
}

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def _needed(query: str, found: dict[str, None]) -> None:
    for name in _NAMES.findall(query):
        if name not in found:
            _needed(CTES[name], found)
            found[name] = None


def oracle(query: str, doubles: str = "", rounding: bool = True) -> str:
    """The query with its CTEs; ``doubles`` are the columns to round like the Spark side."""
    needed: dict[str, None] = {}
    _needed(query, needed)
    parts = [f"{name} AS ({CTES[name]})" for name in needed]
    parts.append(f"answer AS ({query})")
    exact = ", ".join(
        f"round({c} + {shift(c)}::DOUBLE, {digits(c)}) AS {c}" if rounding else f"{c}::DOUBLE AS {c}"
        for c in doubles.split()
    )
    replace = f" REPLACE ({exact})" if exact else ""
    return "WITH " + ",\n".join(parts) + f"\nSELECT *{replace} FROM answer"
