import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from cindergrid.operators import grid, staging

RAW_GRID = (
    "id string, zone string, timestamp timestamp_ntz, carbon_intensity_gco2eq_per_kwh double, "
    "fossil_fuel_percentage double, renewable_percentage double, low_carbon_percentage double, "
    "power_production_breakdown map<string,double>, power_consumption_breakdown map<string,double>, "
    "extracted_at timestamp_ntz"
)
RAW_MOER = (
    "id string, ba string, ba_name string, point_time timestamp_ntz, moer double, "
    "moer_kgco2_per_kwh double, percent int, frequency int, market string, extracted_at timestamp_ntz"
)


def raw_grid(spark, *points):
    return spark.createDataFrame(
        [(f"{z}{t}", z, ts(t), g, f, 100.0 - f if f is not None else None, 30.0, {}, {}, ts(t))
         for z, t, g, f in points],
        RAW_GRID,
    )


def raw_moer(spark, *points):
    return spark.createDataFrame(
        [(f"{b}{t}", b, b, ts(t), m, m * 0.453592 / 1000, p, 300, "RTM", ts(t)) for b, t, m, p in points],
        RAW_MOER,
    )


def test_grid_staging(spark):
    staged = staging.stage_grid(
        raw_grid(spark, ("DE", "2024-01-01 13:45", 300.0, 40.0), ("DE", "2024-01-01 14:00", 0.0, 40.0))
    )
    got = staged.collect()
    assert len(got) == 1
    assert got[0].timestamp_hour == ts("2024-01-01 13:00") and got[0].timestamp_day == ts("2024-01-01")
    assert (got[0].carbon_intensity_kgco2eq_per_kwh, got[0].high_carbon_percentage) == (0.3, 70.0)


def test_hourly_and_fact(spark):
    average = grid.grid_hourly(
        staging.stage_grid(
            raw_grid(
                spark,
                ("DE", "2024-01-01 13:00", 200.0, 40.0),
                ("DE", "2024-01-01 13:30", 400.0, None),
                ("DE", "2024-01-01 14:00", 90.0, 20.0),
            )
        )
    )
    points = [("DE", f"2024-01-01 13:{m:02d}", 1000.0 + m, 10 + m) for m in range(0, 60, 5)]
    marginal = grid.moer_hourly(staging.stage_moer(raw_moer(spark, *points, ("DE", "2024-01-01 15:00", 0.0, 1))))
    fact = grid.fact_grid_intensity(average, marginal).orderBy("timestamp_hour", "data_source").collect()
    assert [(r.timestamp_hour.hour, r.data_source) for r in fact] == [
        (13, "Electricity Maps"), (13, "WattTime"), (14, "Electricity Maps"),
    ]
    first, second, third = fact
    assert (first.carbon_intensity_gco2eq_per_kwh, first.fossil_fuel_percentage) == (300.0, 40.0)
    assert first.percentile_rank is None and first.intensity_category == "Medium"
    assert second.carbon_intensity_gco2eq_per_kwh == pytest.approx(1027.5 * 0.453592)
    assert second.percentile_rank == 37.5 and second.renewable_percentage is None
    assert third.intensity_category == "Very Low"
    assert first.timestamp_week == ts("2024-01-01") and first.timestamp_month == ts("2024-01-01")


def test_fact_with_one_feed(spark):
    marginal = grid.moer_hourly(staging.stage_moer(raw_moer(spark, ("PJM", "2024-01-01 15:00", 5.0, 1))))
    fact = grid.fact_grid_intensity(None, marginal)
    assert fact.select("fossil_fuel_percentage").first()[0] is None


FACT = (
    "grid_region string, timestamp_hour timestamp_ntz, timestamp_day timestamp_ntz, "
    "carbon_intensity_gco2eq_per_kwh double, fossil_fuel_percentage double, "
    "renewable_percentage double, data_source string, extracted_at timestamp_ntz"
)


def fact_of(spark, *readings):
    """(region, time, grams, source)"""
    return spark.createDataFrame(
        [(r, ts(t), ts(t[:10]), g, 40.0, 60.0, s, ts(t)) for r, t, g, s in readings], FACT
    )


@pytest.mark.parametrize(("hours", "complete"), [(19, False), (20, True), (24, True)])
def test_complete_day(spark, hours, complete):
    fact = fact_of(spark, *[("DE", f"2024-01-07 {h:02d}:00", 100.0, "a") for h in range(hours)])
    day = grid.grid_intensity_daily(fact).first()
    assert (day.distinct_hours, day.is_complete_day) == (hours, complete)


def test_daily_statistics(spark):
    fact = fact_of(
        spark,
        ("DE", "2024-01-07 06:00", 250.0, "a"),  # a Sunday; 250 is no longer low
        ("DE", "2024-01-07 07:00", 600.0, "a"),  # 600 is high
        ("DE", "2024-01-07 07:00", 100.0, "b"),
        ("DE", "2024-01-07 22:00", 200.0, "a"),
        ("DE", "2024-01-07 23:00", 350.0, "a"),
        ("FR", "2024-01-01 12:00", 50.0, "a"),
    )
    german, french = grid.grid_intensity_daily(fact).orderBy("grid_region").collect()
    assert (german.hours_reported, german.distinct_hours, german.num_data_sources) == (5, 4, 2)
    assert (german.low_carbon_hours, german.high_carbon_hours) == (2, 1)
    assert german.avg_peak_intensity == 300.0 and german.avg_offpeak_intensity == 300.0
    assert (german.daily_range, german.peak_offpeak_delta) == (500.0, 0.0)
    assert german.stddev_carbon_intensity == pytest.approx(190.3943276)
    assert (german.day_of_week, german.timestamp_week) == (0, ts("2024-01-01"))
    assert french.stddev_carbon_intensity is None and french.avg_offpeak_intensity is None
    assert french.peak_offpeak_delta is None and french.day_of_week == 1


def test_dashboard_names(spark):
    daily = grid.daily_for_dashboards(grid.grid_intensity_daily(fact_of(spark, ("DE", "2024-01-01 00:00", 1.0, "a"))))
    assert {"date", "avg_intensity", "stddev_intensity", "avg_fossil_percentage"} <= set(daily.columns)
    assert daily.schema["date"].dataType.simpleString() == "date"


def test_rollup_across_year_end(spark):
    fact = fact_of(
        spark,
        ("DE", "2024-12-30 00:00", 100.0, "a"),
        ("DE", "2025-01-02 00:00", 300.0, "a"),
    )
    weeks = rows(grid.period_rollup(fact, "week"), "week_start", "avg_intensity", "readings_count")
    assert [(str(w), a, n) for w, a, n in weeks] == [("2024-12-30", 200.0, 2)]
    assert len(rows(grid.period_rollup(fact, "month"))) == 2
    assert len(rows(grid.period_rollup(fact, "day"))) == 2
    with pytest.raises(ValueError):
        grid.period_rollup(fact, "quarter")


def test_invariants_on_test_tables(spark, sf):
    from cindergrid.plans.testbed_queries import daily

    days = daily(spark, sf)
    wrong = days.where(
        (F.col("min_carbon_intensity") > F.col("avg_carbon_intensity") + 1e-9)
        | (F.col("avg_carbon_intensity") > F.col("max_carbon_intensity") + 1e-9)
        | (F.col("distinct_hours") > 24)
    )
    assert days.count() > 0 and wrong.count() == 0
