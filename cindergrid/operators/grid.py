"""Hourly grid facts and the daily, weekly and monthly rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.functions.buckets import INTENSITY, Scale, bucket
from cindergrid.functions.measures import GRAMS_PER_KG
from cindergrid.functions.time import day_of_week, start_of

# Daytime hours, both included, and the hours that make a day complete.
PEAK_FIRST_HOUR, PEAK_LAST_HOUR = 7, 22
COMPLETE_DAY_HOURS = 20

_KG, _G = "carbon_intensity_kgco2eq_per_kwh", "carbon_intensity_gco2eq_per_kwh"


def grid_hourly(staged: DataFrame) -> DataFrame:
    """Readings averaged per zone, hour and source.

    Averages combine map-side: a task sends one row per zone and hour it saw, so a zone with
    a third of all readings costs its reducer no more than any other.
    """
    return staged.groupBy(
        F.col("zone").alias("grid_region"), "timestamp_hour", "timestamp_day", "data_source"
    ).agg(
        F.avg(_KG).alias(_KG),
        F.avg(_G).alias(_G),
        F.avg("fossil_fuel_percentage").alias("fossil_fuel_percentage"),
        F.avg("renewable_percentage").alias("renewable_percentage"),
        F.max("extracted_at").alias("extracted_at"),
    )


def moer_hourly(staged: DataFrame) -> DataFrame:
    """Five-minute marginal rates averaged per authority and hour, with the mean percentile."""
    rate = F.col("moer_kgco2_per_kwh")
    return staged.groupBy(
        F.col("ba").alias("grid_region"),
        F.col("point_time_hour").alias("timestamp_hour"),
        F.col("point_time_day").alias("timestamp_day"),
        "data_source",
    ).agg(
        F.avg(rate).alias(_KG),
        F.avg(rate * GRAMS_PER_KG).alias(_G),
        F.avg("percent").alias("percentile_rank"),
        F.max("extracted_at").alias("extracted_at"),
    )


def fact_grid_intensity(
    grid: DataFrame | None, marginal: DataFrame | None, scale: Scale = INTENSITY
) -> DataFrame:
    """Both hourly feeds under each other; what a feed does not report is NULL."""
    parts = [part for part in (grid, marginal) if part is not None]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    for name in ("fossil_fuel_percentage", "renewable_percentage", "percentile_rank"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("double"))
    return rows.select(
        "grid_region",
        "timestamp_hour",
        "timestamp_day",
        start_of("week", F.col("timestamp_day")).alias("timestamp_week"),
        start_of("month", F.col("timestamp_day")).alias("timestamp_month"),
        _KG,
        _G,
        "fossil_fuel_percentage",
        "renewable_percentage",
        "percentile_rank",
        bucket(F.col(_G), scale).alias("intensity_category"),
        "data_source",
        "extracted_at",
    )


def grid_intensity_daily(fact: DataFrame, scale: Scale = INTENSITY) -> DataFrame:
    """Daily statistics, day and night means, clean and dirty hours, completeness.

    Distinct hours of a day are counted as set bits of an hour mask, which combines map-side;
    that leaves one distinct count, so input rows are never multiplied.
    """
    grams, hour = F.col(_G), F.hour("timestamp_hour")
    by_day = hour.between(PEAK_FIRST_HOUR, PEAK_LAST_HOUR)
    hour_bit = F.expr("shiftleft(1, hour(timestamp_hour))")
    day = fact.groupBy("grid_region", "timestamp_day").agg(
        F.avg(grams).alias("avg_carbon_intensity"),
        F.min(grams).alias("min_carbon_intensity"),
        F.max(grams).alias("max_carbon_intensity"),
        F.stddev_samp(grams).alias("stddev_carbon_intensity"),
        F.avg("fossil_fuel_percentage").alias("avg_fossil_fuel_percentage"),
        F.avg("renewable_percentage").alias("avg_renewable_percentage"),
        F.count("*").alias("hours_reported"),
        F.coalesce(F.bit_count(F.bit_or(hour_bit)), F.lit(0)).cast("bigint").alias("distinct_hours"),
        F.count_if(grams < 250).alias("low_carbon_hours"),
        F.count_if(grams >= 600).alias("high_carbon_hours"),
        F.avg(F.when(by_day, grams)).alias("avg_peak_intensity"),
        F.avg(F.when(~by_day, grams)).alias("avg_offpeak_intensity"),
        F.count_distinct("data_source").alias("num_data_sources"),
        F.max("extracted_at").alias("last_extracted_at"),
    )
    at = F.col("timestamp_day")
    return day.select(
        "grid_region",
        "timestamp_day",
        start_of("week", at).alias("timestamp_week"),
        start_of("month", at).alias("timestamp_month"),
        F.year(at).cast("bigint").alias("year"),
        F.month(at).cast("bigint").alias("month"),
        day_of_week(at).alias("day_of_week"),
        "avg_carbon_intensity",
        "min_carbon_intensity",
        "max_carbon_intensity",
        "stddev_carbon_intensity",
        (F.col("max_carbon_intensity") - F.col("min_carbon_intensity")).alias("daily_range"),
        bucket(F.col("avg_carbon_intensity"), scale).alias("avg_intensity_category"),
        "avg_fossil_fuel_percentage",
        "avg_renewable_percentage",
        "hours_reported",
        "distinct_hours",
        "low_carbon_hours",
        "high_carbon_hours",
        (F.col("distinct_hours") >= COMPLETE_DAY_HOURS).alias("is_complete_day"),
        "avg_peak_intensity",
        "avg_offpeak_intensity",
        (F.col("avg_peak_intensity") - F.col("avg_offpeak_intensity")).alias("peak_offpeak_delta"),
        "num_data_sources",
        "last_extracted_at",
    )


def daily_for_dashboards(daily: DataFrame) -> DataFrame:
    """The daily table under the names the dashboards use."""
    return (
        daily.drop("last_extracted_at")
        .withColumn("timestamp_day", F.col("timestamp_day").cast("date"))
        .withColumnsRenamed(
            {
                "timestamp_day": "date",
                "avg_carbon_intensity": "avg_intensity",
                "min_carbon_intensity": "min_intensity",
                "max_carbon_intensity": "max_intensity",
                "stddev_carbon_intensity": "stddev_intensity",
                "avg_fossil_fuel_percentage": "avg_fossil_percentage",
            }
        )
    )


# The rollups' period columns.
PERIOD_COLUMN = {"day": "date", "week": "week_start", "month": "month_start"}


def day_states(fact: DataFrame) -> DataFrame:
    """What the rollups and statistics of longer periods add up: sums, counts and extremes per region and day.

    States of different days never overlap, so a period is the plain sum of its days, and a month that
    changes changes its own states only. A day is one row of its region, which makes distinct days a count.
    """
    grams = F.col(_G)
    sums = {"intensity": grams, "fossil": F.col("fossil_fuel_percentage"), "renewable": F.col("renewable_percentage")}
    return fact.groupBy("grid_region", "timestamp_day").agg(
        *[total(value).alias(f"{name}_{kind}") for name, value in sums.items() for kind, total in (("sum", F.sum), ("count", F.count))],
        F.min(grams).alias("intensity_min"),
        F.max(grams).alias("intensity_max"),
        F.count("*").alias("readings"),
    ).withColumn("timestamp_month", start_of("month", F.col("timestamp_day")))


def mean_of_states(name: str) -> Column:
    """The mean over many states; NULL if they have no value."""
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))


def rollup_of_states(states: DataFrame, unit: str) -> DataFrame:
    """Plain statistics per region and day, week or month, from the states of days."""
    if unit not in PERIOD_COLUMN:
        raise ValueError(f"unit must be one of {sorted(PERIOD_COLUMN)}, not {unit!r}")
    period = start_of(unit, F.col("timestamp_day")).cast("date").alias(PERIOD_COLUMN[unit])
    return states.groupBy("grid_region", period).agg(
        mean_of_states("intensity").alias("avg_intensity"),
        F.min("intensity_min").alias("min_intensity"),
        F.max("intensity_max").alias("max_intensity"),
        mean_of_states("fossil").alias("avg_fossil_percentage"),
        mean_of_states("renewable").alias("avg_renewable_percentage"),
        F.sum("readings").alias("readings_count"),
    )


def period_rollup(fact: DataFrame, unit: str) -> DataFrame:
    """The rollup straight from the fact."""
    return rollup_of_states(day_states(fact), unit)
