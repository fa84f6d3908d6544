"""Marts follow every change of the raw tables, whatever dies on the way."""

from datetime import date

import pytest
from conftest import plan, rows, ts
from pyspark.sql import functions as F
from test_refresh import grid_line, land
from test_storage import RAW_MOER, points

from cindergrid.operators import upsert
from cindergrid.plans import changes, refresh, warehouse
from cindergrid.streaming.rollup import read_hours, run_hourly


def month(m, scope1, account="a"):
    return {"AccountId": account, "Month": f"2024-0{m}-01", "ServiceName": "S", "Scope1": scope1}


def totals(marts):
    found = marts["fact_cloud_carbon"].groupBy("usage_month_start").agg(F.sum("total_kgco2e").alias("t"))
    return {m.month: t for m, t in rows(found, "usage_month_start", "t")}


COMPARED = {
    "fact_cloud_carbon": ("id", "usage_month_start", "total_kgco2e"),
    "carbon_monthly": ("month", "account_id", "total_kgco2e", "num_services"),
    "carbon_trends_monthly": ("month", "account_id", "total_kgco2e", "prev_month_kgco2e", "ytd_total_kgco2e", "trend_indicator"),
    "fact_grid_intensity": ("grid_region", "timestamp_hour", "carbon_intensity_gco2eq_per_kwh"),
    "grid_intensity_daily": ("grid_region", "timestamp_day", "avg_carbon_intensity", "hours_reported"),
    "grid_day_states": ("grid_region", "timestamp_day", "intensity_sum", "readings"),
    "grid_intensity_weekly": ("grid_region", "week_start", "avg_intensity", "readings_count"),
    "grid_intensity_monthly": ("grid_region", "month_start", "min_intensity", "max_intensity"),
    "dim_grid_regions_derived": ("grid_region", "days_of_data", "first_data_date", "avg_carbon_intensity"),
    "dim_grid_regions_stats": ("grid_region", "days_of_data", "cleanliness_category"),
    "dim_grid_regions": ("grid_region", "days_of_data"),
}


def equals_full_build(spark, tmp_path, raw, marts, folder):
    """What is returned, and what is stored, equal marts built from nothing."""
    full = warehouse.build_marts(spark, refresh.stored_raw(spark, raw), str(tmp_path / f"full-{folder.rsplit('/', 1)[-1]}"))
    assert full.keys() == marts.keys()
    for name in full:
        want = rows(full[name], *COMPARED[name])
        stored = warehouse.open_mart(spark, folder, name)
        assert rows(stored, *COMPARED[name]) == want, name
        if name != "grid_intensity_daily":  # returned in the dashboards' names
            assert rows(marts[name], *COMPARED[name]) == want, name


@pytest.fixture
def folders(tmp_path):
    return tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "marts")


def test_a_month_restated_to_nothing_leaves_the_marts(spark, tmp_path, folders):
    inbox, raw, marts = folders
    land(inbox, "1.json", month(1, 1.0), month(2, 1.0), month(3, 1.0))
    refresh.refresh(spark, {"aws": str(inbox)}, raw, marts)
    land(inbox, "2.json", month(2, 0.0))
    found = refresh.refresh(spark, {"aws": str(inbox)}, raw, marts, touched_only=True)
    assert totals(found) == {1: 1000.0, 3: 1000.0}
    equals_full_build(spark, tmp_path, raw, found, marts)


def test_a_load_whose_marts_were_lost(spark, tmp_path, folders, monkeypatch):
    inbox, raw, marts = folders
    land(inbox, "1.json", *[month(m, 1.0) for m in (1, 2, 3)])
    refresh.refresh(spark, {"aws": str(inbox)}, raw, marts)
    land(inbox, "2.json", month(1, 7.0))
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "follow_changes", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh.refresh(spark, {"aws": str(inbox)}, raw, marts, touched_only=True)
    land(inbox, "3.json", month(3, 5.0))
    found = refresh.refresh(spark, {"aws": str(inbox)}, raw, marts, touched_only=True)
    assert totals(found) == {1: 7000.0, 2: 1000.0, 3: 5000.0}
    equals_full_build(spark, tmp_path, raw, found, marts)


def test_without_changes_nothing_is_built(spark, folders, monkeypatch):
    inbox, raw, marts = folders
    land(inbox, "1.json", month(1, 1.0))
    refresh.refresh(spark, {"aws": str(inbox)}, raw, marts)
    assert changes.waiting(spark, raw).months == {}
    monkeypatch.setattr(refresh, "build_marts", lambda *a, **b: 1 / 0)
    found = refresh.refresh(spark, {"aws": str(inbox)}, raw, marts, touched_only=True)
    assert totals(found) == {1: 1000.0} and found.keys() >= {"carbon_trends_monthly", "carbon_monthly"}


def test_one_month_of_readings_reads_one_month(spark, tmp_path, folders):
    inbox, raw, marts = folders
    land(inbox, "1.json", *[grid_line("DE", *[(f"2024-0{m}-{d:02}T10:00:00Z", m * d) for d in (1, 15, 28)]) for m in (1, 2, 3)],
         grid_line("FR", ("2024-02-29T23:00:00Z", 9)))
    refresh.refresh(spark, {"grid": str(inbox)}, raw, marts)
    kept = sorted(str(p) for p in (tmp_path / "marts").glob("*/timestamp_month=2024-01*/*.parquet"))
    assert len(kept) >= 3
    # February changes in the week that it shares with January, and France goes.
    land(inbox, "2.json", grid_line("DE", ("2024-02-01T10:00:00Z", 77)), grid_line("FR", ("2024-02-29T23:00:00Z", 0)))
    found = refresh.refresh(spark, {"grid": str(inbox)}, raw, marts, touched_only=True)
    assert kept == sorted(str(p) for p in (tmp_path / "marts").glob("*/timestamp_month=2024-01*/*.parquet"))
    equals_full_build(spark, tmp_path, raw, found, marts)
    scope = warehouse._Scope(spark, marts, None, {"grid": [date(2024, 2, 1)]})
    text = plan(scope.fresh(found["fact_grid_intensity"], "fact_grid_intensity", "grid"))
    assert any("timestamp_month" in line for line in text.splitlines() if line.startswith("PartitionFilters"))
    text = plan(scope.raw({"grid": spark.read.parquet(f"{raw}/grid")}, {"grid"}, "grid")["grid"])
    assert any("load_period" in line for line in text.splitlines() if line.startswith("PartitionFilters"))


def test_both_sides_in_any_order(spark, tmp_path, folders):
    inbox, raw, marts = folders
    land(inbox / "aws", "1.json", month(1, 1.0))
    land(inbox / "moer", "1.json", {"ba": "PJM", "data": [{"point_time": "2024-01-01T12:00:00Z", "value": 1}]})
    landed = {feed: str(inbox / feed) for feed in ("aws", "moer")}
    found = refresh.refresh(spark, landed, raw, marts, touched_only=True)
    equals_full_build(spark, tmp_path, raw, found, marts)
    land(inbox / "aws", "2.json", month(4, 2.0, "b"))
    found = refresh.refresh(spark, landed, raw, marts, touched_only=True)
    assert totals(found) == {1: 1000.0, 4: 2000.0} and found["fact_grid_intensity"].count() == 1
    land(inbox / "moer", "2.json", {"ba": "PJM", "data": [{"point_time": "2024-01-01T12:00:00Z", "value": 0}]})
    found = refresh.refresh(spark, landed, raw, marts, touched_only=True)
    assert found["fact_grid_intensity"].count() == 0 and found["dim_grid_regions_stats"].count() == 0


def test_notes_made_during_a_build_stay(spark, tmp_path):
    folder = str(tmp_path / "a b")  # names with blanks too
    rows_in = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 1, 9),), (date(2024, 3, 1),)], "load_period date")
    assert changes.waiting(spark, folder).notes == []
    changes.note(folder, "grid", rows_in)
    seen = changes.waiting(spark, folder)
    changes.note(folder, "aws", rows_in.limit(1))
    changes.strike_out(spark, seen)
    assert seen.of({"grid"}) == [date(2024, 1, 1), date(2024, 3, 1)]
    assert changes.waiting(spark, folder).months == {"aws": [date(2024, 1, 1)]}


def broken(which):
    """A move that dies before, in the middle of, or after the rows are in place."""

    def die(spark, path, staging, schema, by, whole=upsert.move_in):
        if which == "in the middle":
            upsert.remove_folder(spark, f"{path}/usage_month_start=2024-02-01")
        if which == "after":
            merged = spark.read.schema(schema).parquet(f"{staging}/merged")
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        raise RuntimeError("driver lost")

    return die


@pytest.mark.parametrize("which", ["before", "in the middle", "after"])
def test_a_build_that_dies_while_moving_in(spark, tmp_path, folders, monkeypatch, which):
    inbox, raw, marts = folders
    land(inbox, "1.json", month(1, 1.0), month(2, 1.0), month(3, 1.0))
    refresh.refresh(spark, {"aws": str(inbox)}, raw, marts)
    land(inbox, "2.json", month(2, 4.0), month(3, 0.0))
    refresh.load_feed(spark, "aws", str(inbox), raw)
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "move_in", broken(which))
        with pytest.raises(RuntimeError):
            refresh.follow_changes(spark, raw, marts)
    # A reader sees the whole new mart at once, wherever the move stopped.
    assert totals({"fact_cloud_carbon": warehouse.open_mart(spark, marts, "fact_cloud_carbon")}) == {1: 1000.0, 2: 4000.0}
    found = refresh.refresh(spark, {"aws": str(inbox)}, raw, marts, touched_only=True)
    equals_full_build(spark, tmp_path, raw, found, marts)
    assert not list((tmp_path / "marts").glob("*-next"))


@pytest.mark.parametrize("removed", [False, True])
def test_a_whole_mart_is_never_lost(spark, tmp_path, monkeypatch, removed):
    folder = str(tmp_path)
    warehouse.store(spark, spark.range(3), folder, "numbers")

    def die(spark, path, staging, schema, by):
        if removed:
            upsert.remove_folder(spark, path)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "move_in", die)
        with pytest.raises(RuntimeError):
            warehouse.store(spark, spark.range(5), folder, "numbers")
    assert warehouse.open_mart(spark, folder, "numbers").count() == 5
    assert warehouse.store(spark, spark.range(4), folder, "numbers").count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["numbers"]


def test_upsert_removes_keys_and_empty_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = "k int, v int, extracted_at timestamp_ntz, day date"
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    first = spark.createDataFrame([(1, 1, ts("2024-01-01"), one), (2, 1, ts("2024-01-01"), one), (3, 1, ts("2024-01-01"), two), (None, 1, ts("2024-01-01"), two)], kind)
    upsert.upsert_parquet(spark, path, first, ["k"], ["day"])
    gone = spark.createDataFrame([(2, one), (3, two), (None, two), (9, one)], "k int, day date")
    batch = spark.createDataFrame([(2, 5, ts("2024-01-02"), one)], kind)
    upsert.upsert_parquet(spark, path, batch, ["k"], ["day"], removed=gone)
    assert rows(spark.read.schema(kind).parquet(path), "k", "v") == [(1, 1), (2, 5)]
    assert [p.name for p in (tmp_path / "t").glob("day=*")] == ["day=2024-01-01"]
    upsert.upsert_parquet(spark, path, batch.limit(0), ["k"], ["day"], removed=gone.where("k = 2"))
    assert rows(spark.read.schema(kind).parquet(path), "k", "v") == [(1, 1)]


def test_an_hour_corrected_away_leaves_the_stream(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def load(*values):
        points(spark, *values).coalesce(1).write.mode("append").parquet(source)
        run_hourly(spark.readStream.schema(RAW_MOER).parquet(source), out, checkpoint).awaitTermination()
        return rows(read_hours(spark, out), "grid_region", "timestamp_hour", "points")

    one, two = ts("2024-01-01 00:00"), ts("2024-01-02 05:00")
    assert load(("PJM", "2024-01-01 00:05", 900.0), ("PJM", "2024-01-02 05:10", 5.0)) == [("PJM", one, 1), ("PJM", two, 1)]
    assert load(("PJM", "2024-01-01 00:05", 0.0)) == [("PJM", two, 1)]
    assert load(("PJM", "2024-01-02 05:10", 0.0), ("PJM", "2024-01-02 05:15", 3.0)) == [("PJM", two, 1)]
    assert load(("PJM", "2024-01-02 05:15", 0.0)) == []
    assert load(("PJM", "2024-01-01 00:05", 7.0), (None, "2024-01-01 00:05", 7.0)) == [("PJM", one, 1), (None, one, 1)]
    assert load((None, "2024-01-01 00:05", 0.0)) == [("PJM", one, 1)]


def test_an_archive_in_lots(spark, tmp_path, monkeypatch):
    inbox, raw = tmp_path / "in", str(tmp_path / "raw")
    for n in range(12):
        land(inbox, f"{n}.json", grid_line("DE", (f"2024-01-{n + 1:02}T00:00:00Z", n + 1)), "{torn %d" % n)
    lots = []
    read = refresh.landing.read_files
    monkeypatch.setattr(refresh.landing, "read_files", lambda s, f, files: lots.append(len(files)) or read(s, f, files))
    real = refresh._upsert

    def second_dies(*a):
        if len(lots) == 2:
            raise RuntimeError("driver lost")
        return real(*a)

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "_upsert", second_dies)
        with pytest.raises(RuntimeError):
            refresh.load_feed(spark, "grid", str(inbox), raw, files_at_a_time=3)
    first = lots[0]
    lots.clear()
    table = refresh.load_feed(spark, "grid", str(inbox), raw, files_at_a_time=3)
    assert sum(lots) == 12 - first and len(lots) > 1  # what was noted is not read again
    assert table.count() == 12 and spark.read.parquet(f"{raw}/files/grid").count() == 12
    assert spark.read.text(f"{raw}/quarantine/grid").count() == 12
    lots.clear()
    assert refresh.load_feed(spark, "grid", str(inbox), raw).count() == 12 and lots == [0]
    assert [p.name for p in (tmp_path / "raw" / "staging").iterdir()] == []


def test_landed_text_is_parsed_once(spark, tmp_path, monkeypatch):
    """Parsing happens in one write; quarantine and table read what it stored."""
    inbox, raw = tmp_path / "in", str(tmp_path / "raw")
    land(inbox, "1.json", grid_line("DE", ("2024-01-20T10:00:00Z", 1)), "{torn")
    seen = []
    aside = refresh.set_aside
    monkeypatch.setattr(refresh, "set_aside", lambda s, rejected, path: seen.append(plan(rejected)) or aside(s, rejected, path))
    refresh.load_feed(spark, "grid", str(inbox), raw)
    assert seen and all("from_json" not in text and "Scan text" not in text for text in seen)
