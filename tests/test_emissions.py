from datetime import date

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from cindergrid.operators import emissions, staging

RAW = (
    "id string, account_id string, service_name string, region string, usage_month date, "
    "scope1_kgco2e double, scope2_location_based_kgco2e double, scope2_market_based_kgco2e double, "
    "scope3_kgco2e double, total_kgco2e double, extracted_at timestamp_ntz"
)
AT = ts("2024-06-01 00:00")


def native(spark, *values):
    """(id, month, scope1, scope2 location, scope2 market, scope3, total)"""
    return spark.createDataFrame(
        [(i, "acc", "svc", "eu", m, s1, sl, sm, s3, t, AT) for i, m, s1, sl, sm, s3, t in values], RAW
    )


def test_native_staging_filters_and_propagates_null(spark):
    month = date(2024, 1, 17)
    raw = native(
        spark,
        ("ok", month, 1.0, 2.0, 1.5, 3.0, 6.0),
        ("no market", month, 1.0, 2.0, None, 3.0, 6.0),
        ("zero", month, 0.0, 0.0, 0.0, 0.0, 0.0),
        ("negative", month, -1.0, 0.0, 0.0, 0.0, -1.0),
        ("null", month, None, None, None, None, None),
    )
    staged = staging.stage_aws(raw)
    assert rows(staged, "id", "usage_month_start", "total_market_based_kgco2e", "cloud_provider") == [
        ("no market", date(2024, 1, 1), None, "AWS"),
        ("ok", date(2024, 1, 1), 5.5, "AWS"),
    ]


def test_gcp_and_azure_column_names(spark):
    raw = native(spark, ("a", date(2024, 1, 1), 1.0, 2.0, 1.5, 3.0, 6.0))
    gcp = staging.stage_gcp(
        raw.withColumnsRenamed(
            {"account_id": "project_id", "service_name": "service_description", "region": "location_region"}
        )
    )
    azure = staging.stage_azure(raw.withColumnRenamed("account_id", "subscription_id"))
    assert {"project_id", "service_name", "region"} <= set(gcp.columns)
    assert "account_id" in azure.columns
    fact = emissions.fact_cloud_carbon([gcp, azure])
    assert rows(fact, "cloud_provider", "account_id") == [("Azure", "acc"), ("GCP", "acc")]


CCF = (
    "id string, cloud_provider string, account_id string, service_name string, region string, "
    "usage_date date, scope1_kgco2e double, scope2_kgco2e double, scope3_kgco2e double, "
    "total_kgco2e double, kilowatt_hours double, cost_usd double, extracted_at timestamp_ntz"
)


def ccf(spark, *values):
    """(region, day, scope1, scope2, scope3, kwh, cost)"""
    return spark.createDataFrame(
        [
            ("x", "AWS", "acc", "svc", r, d, s1, s2, s3, s1 + s2 + s3, kwh, cost, AT)
            for r, d, s1, s2, s3, kwh, cost in values
        ],
        CCF,
    )


def test_ccf_days_to_months(spark):
    raw = ccf(
        spark,
        ("eu", date(2024, 1, 1), 1.0, 2.0, 3.0, 10.0, 1.0),
        ("eu", date(2024, 1, 31), 1.0, 0.0, 0.0, 10.0, None),
        ("eu", date(2024, 2, 1), 4.0, 0.0, 0.0, 0.0, 0.0),
        ("eu", date(2024, 2, 2), 0.0, 0.0, 0.0, 99.0, 99.0),
        (None, date(2024, 1, 1), 1.0, 0.0, 0.0, 1.0, 1.0),
    )
    staged = staging.stage_ccf(raw)
    got = rows(staged, "id", "usage_month_start", "total_market_based_kgco2e", "total_kilowatt_hours", "total_cost_usd")
    assert got == [
        ("AWS_acc_svc_eu_2024-01", date(2024, 1, 1), 7.0, 20.0, 1.0),
        ("AWS_acc_svc_eu_2024-02", date(2024, 2, 1), 4.0, 0.0, 0.0),
        (None, date(2024, 1, 1), 1.0, 1.0, 1.0),
    ]


def test_fact_measures(spark):
    native_rows = staging.stage_aws(native(spark, ("n", date(2024, 1, 1), 1.0, 2.0, 1.5, 3.0, 6.0)))
    estimates = staging.stage_ccf(
        ccf(
            spark,
            ("eu", date(2024, 1, 1), 1.0, 2.0, 3.0, 12.0, 3.0),
            ("zero", date(2024, 1, 1), 1.0, 2.0, 3.0, 0.0, 0.0),
        )
    )
    fact = emissions.fact_cloud_carbon([native_rows], estimates)
    got = rows(
        fact, "region", "total_kgco2e", "total_location_based_kgco2e", "total_mtco2e",
        "kgco2e_per_dollar", "kgco2e_per_kwh",
    )
    # Native and estimate rows of the same provider and month are both kept.
    assert got == [
        ("eu", 5.5, 6.0, 0.0055, None, None),
        ("eu", 6.0, 6.0, 0.006, 2.0, 0.5),
        ("zero", 6.0, 6.0, 0.006, None, None),
    ]


FACT = (
    "usage_month_start date, cloud_provider string, account_id string, service_name string, "
    "region string, scope1_kgco2e double, scope2_market_based_kgco2e double, scope3_kgco2e double, "
    "total_kgco2e double, total_mtco2e double, cost_usd double, kilowatt_hours double"
)


def fact_of(spark, totals, account="a"):
    return spark.createDataFrame(
        [
            (m, "GCP", account, "svc", "eu", t / 2, t / 4, t / 4, t, t / 1000, None, None)
            for m, t in totals.items()
        ],
        FACT,
    )


def test_trends(spark):
    fact = fact_of(
        spark,
        {
            date(2023, 10, 1): 100.0,
            date(2023, 11, 1): 110.0,  # exactly +10 %: stable
            date(2023, 12, 1): 99.0,  # exactly -10 %: stable
            date(2024, 1, 1): 0.0,
            date(2024, 3, 1): 50.0,  # gap in February; previous row is 0
            date(2024, 4, 1): 60.0,
        },
    )
    got = {r.month: r for r in emissions.carbon_trends(fact).collect()}
    label = {m.month: r.trend_indicator for m, r in got.items()}
    assert label == {
        10: "New Account", 11: "Stable ⏸", 12: "Stable ⏸", 1: "Decreasing ⬇",
        3: "New Account", 4: "Increasing ⬆",
    }
    first, january, march = got[date(2023, 10, 1)], got[date(2024, 1, 1)], got[date(2024, 3, 1)]
    assert first.prev_month_kgco2e is None and first.rolling_3mo_avg_kgco2e == 100.0
    assert january.prev_month_kgco2e == 99.0 and january.ytd_total_kgco2e == 0.0
    assert (january.scope1_percent, january.mom_change_percent) == (0.0, -100.0)
    assert march.prev_month_kgco2e == 0.0 and march.mom_change_percent is None
    assert march.rolling_3mo_avg_kgco2e == pytest.approx((99 + 0 + 50) / 3)
    assert got[date(2023, 12, 1)].ytd_total_kgco2e == 309.0
    assert got[date(2024, 4, 1)].ytd_total_kgco2e == 110.0


def test_trends_order_and_units(spark):
    fact = fact_of(spark, {date(2024, 1, 1): 5.0, date(2024, 2, 1): 6.0}).unionByName(
        fact_of(spark, {date(2024, 2, 1): 7.0}, account="b")
    )
    trends = emissions.carbon_trends(fact)
    assert [(r.month.month, r.account_id) for r in trends.collect()] == [(2, "a"), (2, "b"), (1, "a")]
    tonnes = emissions.trends_in_tonnes(trends)
    assert "ytd_total_kgco2e" not in tonnes.columns
    assert tonnes.agg(F.max("ytd_total_mtco2e")).first()[0] == 0.011


def test_monthly_distinct_counts(spark):
    month = date(2024, 1, 1)
    fact = spark.createDataFrame(
        [
            (month, "GCP", "a", service, region, 1.0, 1.0, 1.0, 3.0, 0.003, 2.0, 4.0)
            for service, region in (("x", "eu"), ("x", "us"), ("y", "eu"), ("x", None))
        ],
        FACT,
    )
    got = emissions.monthly_emissions(fact).first()
    assert (got.num_services, got.num_regions, got.total_kgco2e, got.total_cost_usd) == (2, 2, 12.0, 8.0)


def test_shares_sum_to_hundred(spark, sf):
    from cindergrid.plans.testbed_queries import cloud_fact

    shares = F.col("scope1_percent") + F.col("scope2_percent") + F.col("scope3_percent")
    trends = emissions.carbon_trends(cloud_fact(spark, sf), ordered=False)
    off = trends.where((F.col("total_kgco2e") > 0) & (F.abs(shares - 100) > 1e-6))
    assert trends.count() > 0 and off.count() == 0
