from datetime import datetime

import pytest
from conftest import plan, rows, ts
from pyspark.sql import functions as F

from cindergrid import session
from cindergrid.operators import regions
from cindergrid.plans import api, dashboards, exports, warehouse
from cindergrid.sources import testbed
from cindergrid.streaming.rollup import read_hours, run_hourly
from cindergrid.streaming.upsert import run_upsert
from test_grid import RAW_MOER


@pytest.fixture(scope="module")
def raw(spark, sf):
    return {
        "gcp": testbed.raw_gcp(spark, sf),
        "aws": testbed.raw_aws(spark, sf),
        "azure": testbed.raw_azure(spark, sf),
        "ccf": testbed.raw_ccf(spark, sf),
        "grid": testbed.grid_raw(spark, sf),
        "moer": testbed.moer_raw(spark, sf),
    }


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("marts"))


@pytest.fixture(scope="module")
def marts(spark, raw, folder):
    return warehouse.build_marts(spark, raw, folder)


def test_marts_from_separate_feeds(spark, sf, marts):
    from cindergrid.plans.testbed_queries import cloud_fact, grid_fact

    assert marts["fact_cloud_carbon"].count() == cloud_fact(spark, sf).count()
    assert marts["fact_grid_intensity"].count() == grid_fact(spark, sf).count()
    assert set(marts) >= {"carbon_trends_monthly", "grid_intensity_weekly", "dim_grid_regions"}


def test_month_filter_reads_only_its_folders(marts):
    from datetime import date

    query = api.cloud_emissions(marts["fact_cloud_carbon"], start_month=date(2001, 1, 1))
    text = plan(query)
    filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "usage_month_start" in filters
    grid = api.grid_intensity(marts["fact_grid_intensity"], start_time=datetime(2024, 1, 15, 3))
    filters = [line for line in plan(grid).splitlines() if "Filters" in line]
    assert any("timestamp_month" in f for f in filters if f.startswith("PartitionFilters"))
    assert any("timestamp_hour" in f for f in filters if f.startswith("PushedFilters"))


def test_recent_prunes_by_subquery(marts):
    text = plan(dashboards.current_intensity(marts["fact_grid_intensity"]))
    lines = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert any("timestamp_month" in line and "ubquery" in line for line in lines)


def test_narrow_read(marts):
    text = plan(dashboards.monthly_trend(marts["fact_cloud_carbon"]))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert schema == "ReadSchema: struct<cloud_provider:string,total_mtco2e:double>"


def test_dashboard_over_stored_marts(spark, sf, marts):
    dim = testbed.region_dim(spark, sf)
    stored = regions.datacenter_with_grid(dim, marts["grid_intensity_daily"], marts["fact_cloud_carbon"])
    assert stored.count() == 102


def test_open_mart(spark, marts, folder):
    opened = warehouse.open_mart(spark, folder, "fact_grid_intensity")
    same = marts["fact_grid_intensity"]
    assert sorted(opened.dtypes) == sorted(same.dtypes)
    assert rows(opened, *same.columns) == rows(same)
    text = plan(dashboards.current_intensity(opened))
    lines = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert any("ubquery" in line for line in lines)


def test_backup(spark, marts, folder):
    copy = warehouse.backup(spark, folder, "dim_grid_regions", datetime(2024, 1, 2, 3, 4, 5))
    assert copy.endswith("dim_grid_regions_backup_20240102T030405")
    assert spark.read.parquet(copy).count() == marts["dim_grid_regions"].count()


def test_exports(spark, marts, tmp_path):
    exports.export_parquet(marts, "trends", str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == marts["carbon_trends_monthly"].count()

    exports.export_csv(marts, "cloud_carbon", str(tmp_path / "csv"), limit=7)
    fact = marts["fact_cloud_carbon"]
    read = spark.read.schema(fact.schema).option("header", True).csv(str(tmp_path / "csv"))
    expected = fact.orderBy("usage_month_start", "id").limit(7)
    assert rows(read, "id", "total_kgco2e") == rows(expected, "id", "total_kgco2e")

    counts = exports.dump_csv(marts, str(tmp_path / "dump"))
    assert counts == {name: marts[name].count() for name in counts} and len(counts) == 3

    with pytest.raises(KeyError):
        exports.export_parquet(marts, "secrets", str(tmp_path / "no"))
    with pytest.raises(ValueError):
        exports.export_csv(marts, "trends", str(tmp_path / "no"), limit=0)
    exports.export_csv(marts, "cloud_carbon", str(tmp_path / "whole"))
    assert spark.read.option("header", True).csv(str(tmp_path / "whole")).count() == fact.count()


def test_a_failed_build_keeps_the_old_mart(spark, tmp_path):
    old = warehouse.store(spark, spark.range(3), str(tmp_path), "numbers")
    assert old.count() == 3
    with pytest.raises(Exception, match="broken"):
        warehouse.store(spark, spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), str(tmp_path), "numbers")
    assert spark.read.parquet(str(tmp_path / "numbers")).count() == 3
    assert warehouse.store(spark, spark.range(4), str(tmp_path), "numbers").count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["numbers"]


def test_quotes_survive_a_standard_reader(spark, marts, tmp_path):
    import csv

    odd = 'a "quoted", x'
    fact = marts["fact_cloud_carbon"].limit(1).withColumn("service_name", F.lit(odd))
    exports.export_csv({"fact_cloud_carbon": fact}, "cloud_carbon", str(tmp_path / "csv"))
    (file,) = (tmp_path / "csv").glob("*.csv")
    with file.open(newline="") as lines:
        assert [r["service_name"] for r in csv.DictReader(lines)] == [odd]


def points(spark, *values):
    return spark.createDataFrame(
        [(f"{b}{t}", b, b, ts(t), m, m / 1000, 50, 300, "RTM", ts(t)) for b, t, m in values], RAW_MOER
    )


def test_stream_hourly_takes_late_points(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def load(*values):
        points(spark, *values).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RAW_MOER).parquet(source)
        run_hourly(stream, out, checkpoint).awaitTermination()

    load(("PJM", "2024-01-01 00:05", 100.0), ("PJM", "2024-01-01 01:00", 300.0))
    load(("PJM", "2024-01-01 00:10", 200.0), ("PJM", "2024-01-01 00:15", 0.0))
    load(("PJM", "2024-01-03 05:00", 900.0))
    load(("PJM", "2024-01-01 00:20", 600.0), ("PJM", "2024-01-01 01:00", 400.0))  # days late, corrected
    columns = ("timestamp_hour", "points", "carbon_intensity_gco2eq_per_kwh", "data_source")
    assert rows(read_hours(spark, out), *columns) == [
        (ts("2024-01-01 00:00"), 3, 300.0, "WattTime"),
        (ts("2024-01-01 01:00"), 1, 400.0, "WattTime"),
        (ts("2024-01-03 05:00"), 1, 900.0, "WattTime"),
    ]


def test_stream_equals_batch(spark, sf, tmp_path):
    from cindergrid.operators import grid, staging
    from cindergrid.operators.upsert import latest_per_key

    raw = testbed.moer_raw(spark, sf)
    stream = testbed.moer_raw_from(testbed.event_stream(spark, sf))
    run_hourly(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    batch = grid.moer_hourly(staging.stage_moer(latest_per_key(raw, ["ba", "point_time"])))
    columns = ("grid_region", "timestamp_hour", "percentile_rank")
    assert rows(read_hours(spark, str(tmp_path / "out")), *columns) == rows(batch, *columns)


@pytest.mark.parametrize("streamed", [False, True])
def test_replay_after_a_removed_partition(spark, tmp_path, monkeypatch, streamed):
    """The commit removes the old partition and dies; the staged copy is the only whole one."""
    import shutil

    from cindergrid.operators import upsert

    source, path, checkpoint, staging = (str(tmp_path / n) for n in ("in", "table", "checkpoint", "staging"))
    keys, by = ["ba", "point_time"], ["day"]

    def day(df):
        return df.withColumn("day", F.to_date("point_time"))

    first = day(points(spark, ("PJM", "2024-01-01 00:05", 1.0), ("PJM", "2024-01-01 00:10", 2.0)))
    batch = day(points(spark, ("PJM", "2024-01-01 00:05", 9.0)))

    def merge(rows_in):
        if streamed:
            rows_in.coalesce(1).write.mode("append").parquet(source)
            again()
        else:
            upsert.upsert_parquet(spark, path, rows_in, keys, by, staging=staging)

    def again():
        if streamed:
            stream = spark.readStream.schema(first.schema).parquet(source)
            run_upsert(stream, path, checkpoint, keys, by).awaitTermination()
        else:
            upsert.upsert_parquet(spark, path, batch, keys, by, staging=staging)

    merge(first)

    def die(*args):
        shutil.rmtree(f"{path}/day=2024-01-01")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(upsert, "move_in", die)
        with pytest.raises(Exception, match="driver lost"):
            merge(batch)
    again()
    assert rows(spark.read.schema(first.schema).parquet(path), "moer") == [(2.0,), (9.0,)]
    assert not list(tmp_path.glob("*staging*/*"))  # nothing is left behind


def test_stream_upsert_resumes(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    schema = points(spark).withColumn("day", F.to_date("point_time")).schema

    def load(*values):
        rows_in = points(spark, *values).withColumn("day", F.to_date("point_time"))
        rows_in.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        run_upsert(stream, path, checkpoint, ["ba", "point_time"], ["day"]).awaitTermination()

    load(("PJM", "2024-01-01 00:05", 1.0), ("PJM", "2024-01-02 00:05", 1.0))
    load(("PJM", "2024-01-02 00:05", 2.0), ("PJM", "2024-01-03 00:05", 2.0))
    got = rows(spark.read.schema(schema).parquet(path), "point_time", "moer")
    assert [(t.day, m) for t, m in got] == [(1, 1.0), (2, 2.0), (3, 2.0)]


def test_work_folder_follows_the_cluster(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


def test_utc_is_required(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            session.require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    session.require_utc(session.adopt(spark))
