import json
from datetime import date

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from cindergrid.sources import cursors, feeds, landing, seed


def land(tmp_path, name, lines):
    path = tmp_path / f"{name}.json"
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    return str(path)


def test_gcp_missing_scopes(spark):
    from cindergrid.schemas import LANDED

    landed = spark.createDataFrame(
        [
            (("p",), ("Compute",), ("eu",), date(2024, 3, 1), (1.0, (2.0, None), None)),
            (("p",), ("Compute",), (None,), date(2024, 2, 1), (None, (None, 3.0), 4.0)),
            (("p",), ("Compute",), ("eu",), date(2023, 12, 1), (1.0, (1.0, 1.0), 1.0)),
        ],
        LANDED["gcp"],
    )
    raw = feeds.normalise_gcp(landed, min_month=date(2024, 1, 1))
    got = rows(raw, "id", "usage_month", "scope2_market_based_kgco2e", "total_kgco2e")
    assert got == [
        ("p_Compute_eu_2024-03", date(2024, 3, 1), None, 3.0),
        (None, date(2024, 2, 1), 3.0, 4.0),
    ]


def test_tonnes_defaults_and_corrupt_line(spark, tmp_path):
    path = land(tmp_path, "aws", [
        {"Month": "2024-03-01", "ServiceName": "EC2", "Region": "us", "Scope1": 1.0,
         "Scope2LocationBased": 2.0, "Scope2MarketBased": 0.5, "Scope3": 3.0},
        {"Month": "2024-04-01", "Scope3": 0.25},
        "{broken",
    ])
    landed = landing.read_landing(spark, "tonnes", path).cache()
    assert landing.bad_records(landed).collect()[0][0] == "{broken"
    raw = feeds.normalise_aws(landing.good_records(landed), "123")
    got = rows(raw, "id", "service_name", "region", "scope2_market_based_kgco2e", "total_kgco2e")
    assert got == [
        ("123_EC2_us_2024-03-01", "EC2", "us", 500.0, 6000.0),
        ("123_unknown_global_2024-04-01", "Unknown", "global", 0.0, 250.0),
    ]
    azure = feeds.normalise_azure(landing.good_records(landed), "sub")
    assert "subscription_id" in azure.columns and azure.count() == 2


def test_several_keys_in_one_read(spark, tmp_path):
    good = land(tmp_path, "de", [{"zone": "DE", "history": [{"datetime": "2024-01-01T00:00:00Z"}]}])
    bad = land(tmp_path, "fr", ["no json at all"])
    landed = landing.read_landing(spark, "grid", [good, bad]).cache()
    assert landing.good_records(landed).count() == 1
    assert landing.bad_records(landed).count() == 1


def test_ccf_nested_records(spark, tmp_path):
    path = land(tmp_path, "ccf", [
        {"timestamp": "2024-01-31T00:00:00.000Z", "serviceEstimates": [
            {"cloudProvider": "AWS", "accountId": "1", "serviceName": "S3", "region": "eu",
             "kilowattHours": 5, "scope1": 1, "scope2": 2, "scope3": 3, "cost": 7},
            {"cloudProvider": "GCP", "accountName": "named", "scope2": 2.5},
            {},
        ]},
        {"timestamp": "2024-02-01", "serviceEstimates": []},
        {"timestamp": "2024-02-01"},
    ])
    raw = feeds.normalise_ccf(landing.good_records(landing.read_landing(spark, "ccf", path)))
    assert rows(raw, "id", "usage_date", "total_kgco2e", "kilowatt_hours", "cost_usd") == [
        ("AWS_1_S3_eu_2024-01-31", date(2024, 1, 31), 6.0, 5.0, 7.0),
        ("GCP_named_Unknown_global_2024-01-31", date(2024, 1, 31), 2.5, 0.0, 0.0),
        ("Unknown_unknown_Unknown_global_2024-01-31", date(2024, 1, 31), 0.0, 0.0, 0.0),
    ]


def test_grid_history(spark, tmp_path):
    path = land(tmp_path, "grid", [
        {"zone": "DE", "history": [
            {"datetime": "2024-01-01T00:00:00Z", "carbonIntensity": 300, "fossilFuelPercentage": 40,
             "powerProductionBreakdown": {"wind": 10, "coal": None}},
            {"datetime": "2024-01-01T01:00:00Z"},
        ]},
        {"zone": "FR", "history": []},
    ])
    raw = feeds.normalise_grid_history(landing.good_records(landing.read_landing(spark, "grid", path)))
    got = rows(raw, "id", "timestamp", "carbon_intensity_gco2eq_per_kwh", "power_production_breakdown")
    assert got == [
        ("DE_2024-01-01T00:00:00+00:00", ts("2024-01-01 00:00"), 300.0, {"wind": 10.0, "coal": None}),
        ("DE_2024-01-01T01:00:00+00:00", ts("2024-01-01 01:00"), 0.0, {}),
    ]


def test_moer_units_and_defaults(spark, tmp_path):
    path = land(tmp_path, "moer", [
        {"ba": "PJM", "data": [
            {"point_time": "2024-01-01T00:05:00Z", "value": 1000, "percent": 7, "frequency": 60,
             "market": "DAM", "ba_name": "PJM East"},
            {"point_time": "2024-01-01T00:10:00Z"},
        ]},
    ])
    raw = feeds.normalise_moer(landing.good_records(landing.read_landing(spark, "moer", path)))
    got = rows(raw, "ba_name", "point_time", "moer", "moer_kgco2_per_kwh", "percent", "frequency", "market")
    assert got == [
        ("PJM East", ts("2024-01-01 00:05"), 1000.0, pytest.approx(0.453592), 7, 60, "DAM"),
        ("PJM", ts("2024-01-01 00:10"), 0.0, 0.0, 50, 300, "RTM"),
    ]


def test_parse_landing_keeps_one_parser(spark):
    lines = spark.createDataFrame([('{"ba":"PJM","data":[]}',), ("oops",)], "value string")
    good = landing.good_records(landing.parse_landing(lines, "moer"))
    assert [r.ba for r in good.collect()] == ["PJM"]
    from conftest import plan

    assert plan(good).split("(1)")[0].count("Generate") == 1


@pytest.mark.parametrize(
    ("feed", "start"),
    [
        ("gcp", "2024-02-01 00:00"),  # 90 days before 2024-05-15 lie in February
        ("aws", "2024-02-01 00:00"),
        ("ccf", "2024-02-15 00:00"),
        ("grid", "2024-05-14 10:30"),
        ("moer", "2024-05-14 10:30"),
    ],
)
def test_lookback_start(spark, feed, start):
    now = F.lit("2024-05-15 10:30:00").cast("timestamp_ntz")
    got = spark.range(1).select(cursors.lookback_start(feed, now).cast("timestamp_ntz")).first()[0]
    assert got == ts(start)


@pytest.mark.parametrize(
    ("feed", "loaded", "expected"),
    [
        # The export re-reads its last month; the other month feeds start a day later and
        # never load the current month.
        ("gcp", ["2024-03-01"], ["2024-03-01", "2024-04-01", "2024-05-01"]),
        ("aws", ["2024-03-01"], ["2024-04-01"]),
        ("azure", [], ["2024-02-01", "2024-03-01", "2024-04-01"]),
    ],
)
def test_incremental_months(spark, feed, loaded, expected):
    months = [date(2024, m, 1) for m in range(1, 6)]
    source = spark.createDataFrame([(m,) for m in months], "usage_month date")
    target = spark.createDataFrame([(date.fromisoformat(m),) for m in loaded], "usage_month date")
    got = cursors.incremental_since(source, target, feed, F.lit(date(2024, 5, 20)))
    assert [str(r[0]) for r in rows(got)] == expected


def test_incremental_points(spark):
    times = [ts(f"2024-01-01 00:{m:02d}") for m in (0, 4, 5, 10)]
    source = spark.createDataFrame([(t,) for t in times], "point_time timestamp_ntz")
    target = source.limit(0).unionByName(spark.createDataFrame([(times[0],)], source.schema))
    now = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    got = cursors.incremental_since(source, target, "moer", now)
    assert {r[0].minute for r in rows(got)} == {5, 10}


def test_seed(spark):
    df = seed.seed_grid_regions(spark)
    got = df.collect()
    assert len(got) == 49 and len({r.grid_region for r in got}) == 49
    quebec = next(r for r in got if r.grid_region == "CA-QC")
    assert (quebec.grid_operator, quebec.latitude, quebec.aws_regions) == ("Hydro-Québec", 45.5017, "")
    assert [tuple(r) for r in got] == seed.seed_rows()
