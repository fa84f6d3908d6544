import json

import pytest
from conftest import plan, rows, ts
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cindergrid.operators import emissions
from cindergrid.plans import refresh
from cindergrid.sources import landing


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(
        "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    )


def clock(text):
    return F.lit(text).cast("timestamp_ntz")


def point(time, value):
    return {"point_time": time, "value": value}


def grid_line(zone, *hours, version="2024-02-01"):
    return {"zone": zone, "history": [{"datetime": t, "carbonIntensity": v} for t, v in hours]}


def test_nothing_that_landed_is_lost(spark, tmp_path):
    inbox, raw = tmp_path / "in", str(tmp_path / "raw")
    land(inbox, "1.json", grid_line("DE", ("2024-01-20T10:00:00Z", 1), ("2023-11-01T00:00:00Z", 9)), "{torn")
    table = refresh.load_feed(spark, "grid", str(inbox), raw)
    measure = ("zone", "timestamp", "carbon_intensity_gco2eq_per_kwh")
    # An archive of any age arrives whole.
    assert rows(table, *measure) == [("DE", ts("2023-11-01"), 9.0), ("DE", ts("2024-01-20 10:00"), 1.0)]
    # A lagging zone, a restated hour and an unreadable time.
    land(inbox, "2.json", grid_line("FR", ("2024-01-20T09:00:00Z", 5)),
         grid_line("DE", ("2024-01-20T10:00:00Z", 2), ("2024-01-20T11:00:00Z", 3), ("not a time", 4)))
    table = refresh.load_feed(spark, "grid", str(inbox), raw)
    assert rows(table, *measure) == [
        ("DE", ts("2023-11-01"), 9.0), ("DE", ts("2024-01-20 10:00"), 2.0),
        ("DE", ts("2024-01-20 11:00"), 3.0), ("FR", ts("2024-01-20 09:00"), 5.0),
    ]
    known = rows(table, "id")
    assert rows(refresh.load_feed(spark, "grid", str(inbox), raw, every_file=True), "id") == known
    aside = [r.value for r in spark.read.text(f"{raw}/quarantine/grid").collect()]
    assert aside.count("{torn") == 1 and sum('"zone":"DE"' in line for line in aside) >= 1


def test_files_that_appear_with_an_old_time(spark, tmp_path):
    import os

    inbox, raw = tmp_path / "in", str(tmp_path / "raw")
    zones = lambda: rows(refresh.load_feed(spark, "grid", str(inbox), raw), "zone", "carbon_intensity_gco2eq_per_kwh")
    land(inbox, "1.json", grid_line("DE", ("2024-01-20T10:00:00Z", 1)))
    assert zones() == [("DE", 1.0)]
    # Moved in from a staging folder, with the time it was made there, and an odd name.
    land(inbox, "old [a] {b}, 50%.json", grid_line("FR", ("2024-01-20T10:00:00Z", 5)), "{torn")
    os.utime(inbox / "old [a] {b}, 50%.json", (1_600_000_000, 1_600_000_000))
    assert zones() == [("DE", 1.0), ("FR", 5.0)]
    assert [r.value for r in spark.read.text(f"{raw}/quarantine/grid").collect()] == ["{torn"]
    assert zones() == [("DE", 1.0), ("FR", 5.0)]
    assert spark.read.parquet(f"{raw}/files/grid").count() == 2
    # Written again in place, with an old time too.
    land(inbox, "1.json", grid_line("DE", ("2024-01-20T11:00:00Z", 12)))
    os.utime(inbox / "1.json", (1_500_000_000, 1_500_000_000))
    assert zones() == [("DE", 1.0), ("DE", 12.0), ("FR", 5.0)]


def test_a_restated_month_and_an_explicit_lookback(spark, tmp_path):
    inbox, raw = tmp_path / "in", str(tmp_path / "raw")

    def month(m, scope1):
        return {"AccountId": "a", "Month": m, "ServiceName": "S", "Scope1": scope1}

    land(inbox, "1.json", month("2024-01-01", 1.0), month("2024-04-01", 1.0))
    refresh.load_feed(spark, "aws", str(inbox), raw)
    land(inbox, "2.json", month("2024-01-01", 7.0))
    table = refresh.load_feed(spark, "aws", str(inbox), raw)
    assert rows(table, "scope1_kgco2e") == [(1000.0,), (7000.0,)]
    short = refresh.load_feed(
        spark, "aws", str(inbox), str(tmp_path / "short"), as_of=clock("2024-05-10 00:00:00"), lookback=1
    )
    assert [str(m) for (m,) in rows(short, "usage_month")] == ["2024-04-01"]


def test_died_while_replacing_partitions(spark, tmp_path, monkeypatch):
    from cindergrid.operators import upsert

    inbox, raw = tmp_path / "in", str(tmp_path / "raw")
    land(inbox, "1.json", {"ba": "PJM", "data": [point("2024-01-01T12:00:00Z", 1)]})
    refresh.load_feed(spark, "moer", str(inbox), raw, as_of=clock("2024-01-02 00:00:00"))
    land(inbox, "2.json", {"ba": "PJM", "data": [
        point("2024-01-01T13:00:00Z", 2), point("2024-01-02T13:00:00Z", 3)]})

    def half(spark, path, staging, schema, partition_by):
        merged = spark.read.schema(schema).parquet(f"{staging}/merged")
        merged.where("load_period = '2024-01-02'").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*partition_by).parquet(path)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(upsert, "move_in", half)
        with pytest.raises(RuntimeError):
            refresh.load_feed(spark, "moer", str(inbox), raw, as_of=clock("2024-01-03 00:00:00"))
    # The newest point is in, an older one is not: the cursor alone would skip it for good.
    assert rows(spark.read.parquet(f"{raw}/moer"), "moer") == [(1.0,), (3.0,)]
    table = refresh.load_feed(spark, "moer", str(inbox), raw, as_of=clock("2024-01-03 00:00:00"))
    assert rows(table, "moer") == [(1.0,), (2.0,), (3.0,)]


def test_incremental_equals_full_reload(spark, tmp_path):
    step, full, inbox = str(tmp_path / "step"), str(tmp_path / "full"), tmp_path / "in"
    for n, m in enumerate((3, 1, 4, 2)):
        land(inbox, f"{n}.json", {"AccountId": "a", "Month": f"2024-0{m}-01", "ServiceName": "S", "Scope1": m + 1.0})
        stepwise = refresh.load_feed(spark, "aws", str(inbox), step)
    at_once = refresh.load_feed(spark, "aws", str(inbox), full)
    assert rows(stepwise, "id", "scope1_kgco2e") == rows(at_once, "id", "scope1_kgco2e")
    assert at_once.count() == 4


def test_follow_feed(spark, tmp_path):
    inbox, raw, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    for n, value in enumerate((1, 2)):
        land(inbox, f"{n}.json", {"zone": "DE", "history": [
            {"datetime": f"2024-01-0{n + 1}T00:00:00Z", "carbonIntensity": value}]})
        refresh.follow_feed(spark, "grid", str(inbox), raw, checkpoint).awaitTermination()
    table = spark.read.parquet(f"{raw}/grid")
    assert rows(table, "zone", "carbon_intensity_gco2eq_per_kwh") == [("DE", 1.0), ("DE", 2.0)]
    land(inbox, "bad.json", "{torn", {"zone": "DE", "history": [{"datetime": "never", "carbonIntensity": 1}]})
    refresh.follow_feed(spark, "grid", str(inbox), raw, checkpoint).awaitTermination()
    assert spark.read.parquet(f"{raw}/grid").count() == 2
    assert spark.read.text(f"{raw}/quarantine/grid").count() == 2


def test_dashboards_from_landing_without_adapters(spark, tmp_path):
    from datetime import date

    from cindergrid import schemas
    from cindergrid.operators import quality, regions
    from cindergrid.plans import dashboards

    inbox = tmp_path / "in"
    land(inbox / "aws", "a.json", {"AccountId": "a", "Month": "2024-04-01", "Region": "eu-central-1", "Scope1": 1.0})
    land(inbox / "grid", "a.json", grid_line("DE", ("2024-05-09T22:00:00Z", 50), ("2024-05-09T23:00:00Z", 70)))
    land(inbox / "moer", "a.json", {"ba": "PJM", "data": [point("2024-05-09T23:00:00Z", 100)]})
    landed = {feed: str(inbox / feed) for feed in ("aws", "grid", "moer")}
    marts = refresh.refresh(spark, landed, str(tmp_path / "raw"), str(tmp_path / "marts"))
    quality.require_contract(marts, schemas.REQUIRED_COLUMNS)
    dim, fact, readings = marts["dim_grid_regions"], marts["fact_cloud_carbon"], marts["fact_grid_intensity"]
    daily, trends = marts["grid_intensity_daily"], marts["carbon_trends_monthly"]
    model = spark.read.parquet(str(tmp_path / "marts" / "grid_intensity_daily"))
    with_grid = regions.datacenter_with_grid(dim, model, fact)
    as_of = date(2024, 5, 10)
    for result in (
        dashboards.datacenter_mapping(dim), with_grid, dashboards.datacenter_map(with_grid),
        dashboards.cleanest_datacenters(with_grid), dashboards.current_intensity(readings),
        dashboards.intensity_trend(readings), dashboards.by_category(readings), dashboards.map_data(readings, dim),
        dashboards.daily_averages(daily, dim, as_of), dashboards.weekly_comparison(daily, dim, as_of),
        dashboards.monthly_regional_trends(marts["grid_intensity_monthly"], dim), dashboards.cloud_totals(fact),
        dashboards.monthly_trend(fact), dashboards.scope_breakdown(fact), dashboards.datacenter_emissions(fact),
        dashboards.datacenter_totals(fact), dashboards.latest_trends(emissions.trends_in_tonnes(trends)),
        dashboards.year_to_date(emissions.trends_in_tonnes(trends)),
    ):
        assert result.count() > 0
    assert dashboards.mom_change(emissions.trends_in_tonnes(trends)).count() == 0


def test_only_touched_months_are_rebuilt(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "1.json", *[{"AccountId": "a", "Month": f"2024-0{m}-01", "Scope1": 1.0} for m in (1, 2, 3)])
    folders = (str(tmp_path / "raw"), str(tmp_path / "marts"))
    refresh.refresh(spark, {"aws": str(inbox)}, *folders)
    old = tmp_path / "marts" / "fact_cloud_carbon" / "usage_month_start=2024-01-01"
    before = sorted(p.name for p in old.glob("*.parquet"))
    land(tmp_path / "more", "2.json", {"AccountId": "a", "Month": "2024-02-01", "Scope1": 5.0})
    marts = refresh.refresh(spark, {"aws": str(tmp_path / "more")}, *folders, touched_only=True)
    assert before == sorted(p.name for p in old.glob("*.parquet"))
    assert [v for _, v in rows(marts["fact_cloud_carbon"], "usage_month_start", "total_kgco2e")] == [1000.0, 5000.0, 1000.0]


def test_refresh_to_marts(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox / "aws", "a.json", {"AccountId": "a", "Month": "2024-04-01", "Scope1": 1.0})
    land(inbox / "azure", "a.json", {"AccountId": "b", "Month": "2024-04-01", "Scope1": 2.0})
    land(inbox / "ccf", "a.json", {"timestamp": "2024-05-01T00:00:00Z", "serviceEstimates": [
        {"cloudProvider": "GCP", "accountId": "c", "scope1": 3, "cost": 2, "kilowattHours": 6}]})
    land(inbox / "moer", "a.json", {"ba": "PJM", "data": [point("2024-05-09T23:00:00Z", 100)]})
    landed = {feed: str(inbox / feed) for feed in ("aws", "azure", "ccf", "moer")}
    marts = refresh.refresh(
        spark, landed, str(tmp_path / "raw"), str(tmp_path / "marts"), clock("2024-05-10 00:00:00")
    )
    assert rows(marts["fact_cloud_carbon"], "cloud_provider", "total_kgco2e", "kgco2e_per_dollar") == [
        ("AWS", 1000.0, None), ("Azure", 2000.0, None), ("GCP", 3.0, 1.5),
    ]
    assert marts["fact_grid_intensity"].first().grid_region == "PJM"
    assert marts["carbon_trends_monthly"].count() == 3
    assert "processed_at" in marts["dim_grid_regions"].columns


def test_marts_of_one_side_only(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "a.json", {"ba": "PJM", "data": [point("2024-05-09T23:00:00Z", 100)]})
    marts = refresh.refresh(
        spark, {"moer": str(inbox)}, str(tmp_path / "raw"), str(tmp_path / "marts"),
        clock("2024-05-10 00:00:00"),
    )
    assert "fact_cloud_carbon" not in marts and marts["grid_intensity_weekly"].count() == 1
    # A later run of another feed keeps what the first one loaded.
    land(inbox / "grid", "a.json", {"zone": "DE", "history": [
        {"datetime": "2024-05-09T22:00:00Z", "carbonIntensity": 50}]})
    marts = refresh.refresh(
        spark, {"grid": str(inbox / "grid")}, str(tmp_path / "raw"), str(tmp_path / "marts"),
        clock("2024-05-10 00:00:00"),
    )
    assert rows(marts["fact_grid_intensity"], "grid_region") == [("DE",), ("PJM",)]


def test_building_from_a_month_on(spark, sf, tmp_path):
    from datetime import date

    from cindergrid.plans import warehouse
    from cindergrid.sources import testbed

    raw = {
        "aws": testbed.raw_aws(spark, sf),
        "ccf": testbed.raw_ccf(spark, sf),
        "moer": testbed.moer_raw(spark, sf),
    }
    full = warehouse.build_marts(spark, raw, str(tmp_path / "full"))
    first = {
        **raw,
        "aws": raw["aws"].where("usage_month < '2001-03-01'"),
        "ccf": raw["ccf"].where("usage_date < '2001-03-15'"),
    }
    folder = tmp_path / "steps"
    warehouse.build_marts(spark, first, str(folder))
    old = folder / "fact_cloud_carbon" / "usage_month_start=2001-02-01"
    before = sorted(p.name for p in old.glob("*.parquet"))
    steps = warehouse.build_marts(spark, raw, str(folder), since=date(2001, 3, 15))
    assert before == sorted(p.name for p in old.glob("*.parquet"))
    for name, columns in {
        "fact_cloud_carbon": ("id", "usage_month_start"),
        "carbon_trends_monthly": ("month", "account_id", "num_regions", "trend_indicator"),
        "grid_intensity_daily": ("grid_region", "timestamp_day", "distinct_hours"),
    }.items():
        assert rows(steps[name], *columns) == rows(full[name], *columns), name


def test_only_new_files_are_read(spark, tmp_path):
    import os
    from datetime import datetime

    land(tmp_path, "old.json", {"ba": "OLD", "data": []})
    land(tmp_path, "new.json", {"ba": "NEW", "data": []})
    os.utime(tmp_path / "old.json", (1_600_000_000, 1_600_000_000))
    landed = landing.read_landing(spark, "moer", str(tmp_path), landed_after=datetime(2021, 1, 1))
    assert [r.ba for r in landed.collect()] == ["NEW"]


def test_absent_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        landing.read_landing(spark, "moer", str(tmp_path / "nothing")).count()


def test_typed_export_with_a_month_bound(spark, sf, tmp_path):
    from datetime import date

    from cindergrid.schemas import LANDED
    from cindergrid.sources import testbed

    path = str(tmp_path / "export")
    testbed.landed_gcp(spark, sf).select(*spark.createDataFrame([], LANDED["gcp"]).columns).write.parquet(path)
    export = landing.read_export(spark, path, date(2000, 1, 1))
    assert "PushedFilters: [IsNotNull(usage_month), GreaterThanOrEqual(usage_month,2000-01-01)]" in plan(export)
    table = refresh.load_export(spark, path, str(tmp_path / "raw"), date(2000, 1, 1))
    keys = ("project_id", "service_description", "location_region", "usage_month")
    assert table.count() == export.select("project.id", "service.description", "location.region", "usage_month").distinct().count()
    assert rows(table.agg(F.min("usage_month").alias("m")))[0][0] >= date(2000, 1, 1) and set(keys) <= set(table.columns)
