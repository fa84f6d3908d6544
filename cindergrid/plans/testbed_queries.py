"""Every operator as a query over the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.functions.buckets import CLEANLINESS, WIDE_INTENSITY, bucket
from cindergrid.operators import emissions, grid, quality, regions, staging, upsert
from cindergrid.plans import api, dashboards, exports, refresh, warehouse
from cindergrid.schemas import REQUIRED_COLUMNS
from cindergrid.session import work_folder
from cindergrid.sources import cursors, feeds, landing, seed, testbed
from cindergrid.streaming.rollup import read_hours, run_hourly
from cindergrid.streaming.upsert import run_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared tables -----------------------------------------------------------------------


def cloud_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The native feeds pass the staging together, so lineitem is read twice, not four times."""
    lines = testbed.emission_lines(spark, sf)
    native = staging.stage_native(testbed.native_monthly(lines), F.col("cloud_provider"))
    return emissions.fact_cloud_carbon([native], staging.stage_ccf(testbed.ccf_daily(lines)))


def grid_fact(spark: SparkSession, sf: str) -> DataFrame:
    raw = {"grid": testbed.grid_raw(spark, sf), "moer": testbed.moer_raw(spark, sf)}
    return warehouse.build_grid_fact(raw)


def trends(spark: SparkSession, sf: str) -> DataFrame:
    return emissions.carbon_trends(cloud_fact(spark, sf), ordered=False)


def trends_t(spark: SparkSession, sf: str) -> DataFrame:
    return emissions.trends_in_tonnes(trends(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return grid.grid_intensity_daily(grid_fact(spark, sf))


def daily_dash(spark: SparkSession, sf: str) -> DataFrame:
    return grid.daily_for_dashboards(daily(spark, sf))


def newest(spark: SparkSession, sf: str, name: str, column: str) -> Column:
    return testbed.table(spark, sf, name).agg(F.max(column).alias("newest")).scalar()


def _text_maps(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: F.to_json(c) for c in ("power_production_breakdown", "power_consumption_breakdown")}
    )


# --- ingest ------------------------------------------------------------------------------


@query
def ingest_gcp(spark, sf):
    return feeds.normalise_gcp(
        testbed.landed_gcp(spark, sf), min_month=date(1996, 1, 1), extracted_at=F.col("extracted_at")
    )


@query
def ingest_aws(spark, sf):
    landed = landing.good_records(testbed.landed_tonnes(spark, sf, "AWS"))
    return feeds.normalise_aws(landed, F.col("AccountId")).drop("extracted_at")


@query
def ingest_azure(spark, sf):
    landed = landing.good_records(testbed.landed_tonnes(spark, sf, "Azure"))
    return feeds.normalise_azure(landed, F.col("AccountId")).drop("extracted_at")


@query
def ingest_ccf(spark, sf):
    landed = landing.good_records(testbed.landed_ccf(spark, sf))
    return feeds.normalise_ccf(landed).drop("extracted_at")


@query
def ingest_grid_history(spark, sf):
    landed = landing.good_records(testbed.landed_grid(spark, sf))
    return _text_maps(feeds.normalise_grid_history(landed).drop("extracted_at"))


@query
def ingest_moer(spark, sf):
    landed = landing.good_records(testbed.landed_moer(spark, sf))
    return feeds.normalise_moer(landed).drop("extracted_at")


def _feed_groups(spark: SparkSession, sf: str) -> list[tuple[DataFrame, list[str], Column]]:
    """Raw rows with their ``feed``, feeds of one source in one pass, and the source's newest moment."""
    shipped = newest(spark, sf, "lineitem", "l_shipdate")
    seen = newest(spark, sf, "events", "ts")
    native = testbed.native_raw(spark, sf).withColumn("feed", F.lower("cloud_provider"))
    alone = {"ccf": (testbed.raw_ccf(spark, sf), shipped), "grid": (testbed.grid_raw(spark, sf), seen), "moer": (testbed.moer_raw(spark, sf), seen)}
    return [(native, ["gcp", "aws", "azure"], shipped)] + [
        (rows.withColumn("feed", F.lit(feed)), [feed], now) for feed, (rows, now) in alone.items()
    ]


def _extents(rows: DataFrame, feeds_in: list[str], start: Callable[[str], Column], now: Column) -> DataFrame:
    """Rows, first and last moment of each feed's window."""
    inside = F.lit(False)
    for feed in feeds_in:
        inside = F.when(F.col("feed") == feed, cursors.in_window(feed, start(feed), now)).otherwise(inside)
    at = F.when(inside, F.col(cursors.LOAD_WINDOWS[feeds_in[0]].cursor).cast("timestamp_ntz"))
    return rows.groupBy("feed").agg(
        F.count(at).alias("record_count"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )


@query
def lookback_window(spark, sf):
    return reduce(
        DataFrame.unionByName,
        [
            _extents(rows, names, lambda feed, now=now: cursors.lookback_start(feed, now), now)
            for rows, names, now in _feed_groups(spark, sf)
        ],
    )


@query
def incremental_since(spark, sf):
    """An earlier run had loaded all but the last 150 days (feeds of hours: the last 36 hours)."""
    extents = []
    for rows, names, now in _feed_groups(spark, sf):
        rule = cursors.LOAD_WINDOWS[names[0]]
        back = F.expr("INTERVAL 36 HOURS" if rule.unit == "hour" else "INTERVAL 150 DAYS")
        at = F.col(rule.cursor)
        loaded = [F.max(F.when((F.col("feed") == feed) & (at <= now - back), at)).alias(feed) for feed in names]
        # One subquery has the marks of all feeds of the group; rows are not joined with it.
        marks = rows.agg(F.struct(*loaded).alias("marks")).scalar()
        extents.append(_extents(
            rows, names,
            lambda feed, now=now, marks=marks: F.coalesce(
                cursors.resume_start(feed, marks[feed]), cursors.lookback_start(feed, now)
            ),
            now,
        ))
    return reduce(DataFrame.unionByName, extents)


UPSERT_KEY = ["cloud_provider", "account_id", "service_name", "region", "usage_month"]


@query
def merge_upsert(spark, sf):
    """The last 90 days arrive again in two versions; the later one, 10 % higher, must win."""
    target = testbed.native_raw(spark, sf)
    recent = target.where(
        F.col("usage_month") >= F.date_sub(newest(spark, sf, "lineitem", "l_shipdate").cast("date"), 90)
    )
    version = F.col("version")
    batch = (
        recent.withColumn("version", F.explode(F.array(F.lit(1), F.lit(0))))
        .withColumn("extracted_at", F.col("extracted_at") + F.make_dt_interval(version))
        .withColumn("total_kgco2e", F.col("total_kgco2e") * (1 + version / 10))
        .drop("version")
    )
    return upsert.merge_upsert(target, batch, UPSERT_KEY)


@query
def seed_grid_regions(spark, sf):
    return regions.seed_with_stats(seed.seed_grid_regions(spark), grid_fact(spark, sf))


# --- exports -----------------------------------------------------------------------------


@query
def export_parquet(spark, sf):
    folder = work_folder(spark, "export_parquet")
    exports.export_parquet({"fact_cloud_carbon": cloud_fact(spark, sf)}, "cloud_carbon", folder)
    return spark.read.parquet(folder)


def _exported(spark: SparkSession, sf: str, limit: int | None) -> DataFrame:
    folder = work_folder(spark, "export_csv")
    fact = cloud_fact(spark, sf)
    exports.export_csv({"fact_cloud_carbon": fact}, "cloud_carbon", folder, limit)
    return spark.read.schema(fact.schema).options(**exports.CSV).csv(folder)


@query
def export_csv(spark, sf):
    return _exported(spark, sf, None)


@query
def export_csv_limited(spark, sf):
    return _exported(spark, sf, 10_000)


@query
def export_csv_dump(spark, sf):
    """What a reader finds in each file: rows, keys and the mean of a measure."""
    folder = work_folder(spark, "export_csv_dump")
    fact = cloud_fact(spark, sf)
    marts = {
        "fact_cloud_carbon": fact,
        "fact_grid_intensity": grid_fact(spark, sf),
        "carbon_trends_monthly": emissions.carbon_trends(fact, ordered=False),
    }
    exports.dump_csv(marts, folder)
    contents = {
        "fact_cloud_carbon": (["id"], "total_kgco2e"),
        "fact_grid_intensity": (["grid_region", "timestamp_hour", "data_source"], "carbon_intensity_gco2eq_per_kwh"),
        "carbon_trends_monthly": (["month", "cloud_provider", "account_id"], "total_kgco2e"),
    }
    return reduce(
        DataFrame.unionByName,
        [
            spark.read.schema(marts[name].schema)
            .options(**exports.CSV)
            .csv(f"{folder}/{name}")
            .agg(
                F.count("*").alias("row_count"),
                F.count_distinct(F.struct(*keys)).alias("key_count"),
                F.avg(measure).alias("measure_mean"),
            )
            .select(F.lit(name).alias("table_name"), "row_count", "key_count", "measure_mean")
            for name, (keys, measure) in contents.items()
        ],
    )


# --- staging -----------------------------------------------------------------------------


@query
def stg_gcp(spark, sf):
    return staging.stage_gcp(testbed.raw_gcp(spark, sf))


@query
def stg_aws(spark, sf):
    return staging.stage_aws(testbed.raw_aws(spark, sf))


@query
def stg_azure(spark, sf):
    return staging.stage_azure(testbed.raw_azure(spark, sf))


@query
def stg_ccf(spark, sf):
    return staging.stage_ccf(testbed.raw_ccf(spark, sf))


@query
def stg_grid(spark, sf):
    return _text_maps(staging.stage_grid(testbed.grid_raw(spark, sf)))


@query
def stg_moer(spark, sf):
    return staging.stage_moer(testbed.moer_raw(spark, sf))


# --- marts -------------------------------------------------------------------------------


@query
def fact_cloud_carbon(spark, sf):
    return cloud_fact(spark, sf)


@query
def grid_hourly(spark, sf):
    return grid.grid_hourly(staging.stage_grid(testbed.grid_raw(spark, sf)))


@query
def moer_hourly(spark, sf):
    return grid.moer_hourly(staging.stage_moer(testbed.moer_raw(spark, sf)))


@query
def fact_grid_intensity(spark, sf):
    return grid_fact(spark, sf)


@query
def intensity_category(spark, sf):
    grams = F.col("carbon_intensity_gco2eq_per_kwh")
    return grid_fact(spark, sf).select(
        "grid_region",
        "timestamp_hour",
        "data_source",
        "intensity_category",
        bucket(grams, WIDE_INTENSITY).alias("wide_category"),
        bucket(grams, CLEANLINESS).alias("cleanliness_category"),
    )


@query
def grid_intensity_daily(spark, sf):
    return daily(spark, sf)


@query
def grid_daily_renamed(spark, sf):
    return daily_dash(spark, sf)


@query
def grid_rollup_day(spark, sf):
    return grid.period_rollup(grid_fact(spark, sf), "day")


@query
def grid_rollup_week(spark, sf):
    return grid.period_rollup(grid_fact(spark, sf), "week")


@query
def grid_rollup_month(spark, sf):
    return grid.period_rollup(grid_fact(spark, sf), "month")


@query
def region_stats(spark, sf):
    return regions.region_stats(grid_fact(spark, sf))


@query
def region_metadata(spark, sf):
    return regions.with_region_metadata(grid_fact(spark, sf).select("grid_region").distinct())


@query
def dim_grid_regions(spark, sf):
    return regions.dim_grid_regions(grid_fact(spark, sf))


@query
def carbon_monthly(spark, sf):
    return emissions.monthly_emissions(cloud_fact(spark, sf))


@query
def carbon_trends(spark, sf):
    return emissions.carbon_trends(cloud_fact(spark, sf))


# --- parametric queries ------------------------------------------------------------------


@query
def q_cloud(spark, sf):
    return api.cloud_emissions(
        cloud_fact(spark, sf),
        provider="GCP",
        start_month=date(1996, 1, 1),
        end_month=date(2001, 6, 1),
        service_name="o",
        limit=5000,
    )


@query
def q_cloud_summary(spark, sf):
    return api.cloud_summary(cloud_fact(spark, sf), start_month=date(1996, 1, 1))


@query
def q_grid(spark, sf):
    return api.grid_intensity(
        grid_fact(spark, sf),
        region="o",
        start_time=datetime(2024, 1, 5),
        end_time=datetime(2024, 1, 25, 12),
        limit=2000,
    )


@query
def q_grid_current(spark, sf):
    return api.current_grid_intensity(grid_fact(spark, sf))


@query
def q_trends(spark, sf):
    return api.trend_rows(trends(spark, sf), provider="AWS", limit=48)


AD_HOC = """
WITH busy AS (
    SELECT grid_region, count(*) AS hours_seen, avg(carbon_intensity_gco2eq_per_kwh) AS avg_intensity
    FROM fact_grid_intensity
    GROUP BY grid_region
)
SELECT grid_region, hours_seen, avg_intensity FROM busy WHERE avg_intensity > 100
"""


@query
def q_sql(spark, sf):
    api.register_views({"fact_grid_intensity": grid_fact(spark, sf)})
    return api.ad_hoc(spark, AD_HOC)


# --- dashboards --------------------------------------------------------------------------


def _with_grid(spark: SparkSession, sf: str) -> DataFrame:
    return regions.datacenter_with_grid(
        testbed.region_dim(spark, sf), daily(spark, sf), cloud_fact(spark, sf)
    )


def _as_of(spark: SparkSession, sf: str) -> Column:
    return newest(spark, sf, "events", "ts").cast("date")


@query
def d_cloud_totals(spark, sf):
    return dashboards.cloud_totals(cloud_fact(spark, sf))


@query
def d_monthly_trend(spark, sf):
    return dashboards.monthly_trend(cloud_fact(spark, sf))


@query
def d_scope_breakdown(spark, sf):
    return dashboards.scope_breakdown(cloud_fact(spark, sf))


@query
def d_trends(spark, sf):
    return dashboards.latest_trends(trends_t(spark, sf))


@query
def d_mom_change(spark, sf):
    return dashboards.mom_change(trends_t(spark, sf))


@query
def d_ytd(spark, sf):
    return dashboards.year_to_date(trends_t(spark, sf))


@query
def d_dc_emissions(spark, sf):
    return dashboards.datacenter_emissions(cloud_fact(spark, sf))


@query
def d_dc_totals(spark, sf):
    return dashboards.datacenter_totals(cloud_fact(spark, sf))


@query
def d_dc_mapping(spark, sf):
    return dashboards.datacenter_mapping(testbed.region_dim(spark, sf))


@query
def datacenter_with_grid(spark, sf):
    return _with_grid(spark, sf)


@query
def d_dc_map(spark, sf):
    return dashboards.datacenter_map(_with_grid(spark, sf))


@query
def d_cleanest(spark, sf):
    return dashboards.cleanest_datacenters(_with_grid(spark, sf))


@query
def d_current_24h(spark, sf):
    return dashboards.current_intensity(grid_fact(spark, sf))


@query
def d_trend_7d(spark, sf):
    return dashboards.intensity_trend(grid_fact(spark, sf))


@query
def d_by_category(spark, sf):
    return dashboards.by_category(grid_fact(spark, sf))


@query
def d_map(spark, sf):
    return dashboards.map_data(grid_fact(spark, sf), testbed.region_dim(spark, sf))


@query
def d_daily_avg(spark, sf):
    return dashboards.daily_averages(
        daily_dash(spark, sf), testbed.region_dim(spark, sf), _as_of(spark, sf)
    )


@query
def d_weekly_cmp(spark, sf):
    return dashboards.weekly_comparison(
        daily_dash(spark, sf), testbed.region_dim(spark, sf), _as_of(spark, sf)
    )


@query
def d_monthly_regional(spark, sf):
    monthly = grid.period_rollup(grid_fact(spark, sf), "month")
    return dashboards.monthly_regional_trends(monthly, testbed.region_dim(spark, sf))


# --- streaming ---------------------------------------------------------------------------


@query
def stream_hourly(spark, sf):
    folder = work_folder(spark, "stream_hourly")
    raw = testbed.moer_raw_from(testbed.event_stream(spark, sf))
    run_hourly(raw, folder, f"{folder}-checkpoint").awaitTermination()
    return read_hours(spark, folder)


@query
def stream_corrected(spark, sf):
    """Every third hour is corrected to nothing after the stream has read it, so it must go again."""
    folder = work_folder(spark, "stream_corrected")
    points = testbed.moer_raw(spark, sf)
    corrections = points.where(F.hour("point_time") % 3 == 0).withColumns(
        {"moer": F.lit(0.0), "moer_kgco2_per_kwh": F.lit(0.0), "extracted_at": F.col("extracted_at") + F.expr("INTERVAL 1 DAY")}
    )
    for landed in (points, corrections):
        landed.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(points.schema).parquet(f"{folder}/in")
        run_hourly(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_hours(spark, f"{folder}/out")


@query
def refresh_touched(spark, sf):
    """The marts follow restated, lost and late months without being built anew.

    Of the months of the year, every fourth lands late, the one before it is restated to nothing, and the one
    after it is doubled by a load whose marts are never built.
    """
    folder = work_folder(spark, "refresh_touched")
    raw, marts = f"{folder}/raw", f"{folder}/marts"
    kind = F.month("usage_month") % 4

    def land(number: int, which: Column, factor: float) -> dict[str, str]:
        lines = testbed.tonnes_lines(testbed.native_raw(spark, sf, "AWS"), factor)
        lines.where(which).select("value").write.text(f"{folder}/in/{number}")
        return {"aws": f"{folder}/in/{number}"}

    refresh.refresh(spark, land(1, kind != 2, 1.0), raw, marts)
    refresh.refresh(spark, land(2, kind == 0, 0.0), raw, marts, touched_only=True)
    refresh.load_feed(spark, "aws", land(3, kind == 1, 2.0)["aws"], raw)
    found = refresh.refresh(spark, land(4, kind == 2, 1.0), raw, marts, touched_only=True)
    return found["fact_cloud_carbon"].select(
        "cloud_provider", "account_id", "service_name", "region", "usage_month_start", "scope1_kgco2e", "scope3_kgco2e",
        "total_kgco2e", "total_mtco2e",
    )


@query
def load_late(spark, sf):
    """The odd days land after the even ones have been loaded; nothing may be missing."""
    folder = work_folder(spark, "load_late")
    lines = testbed.moer_lines(spark, sf)
    for landing_no, odd in enumerate((0, 1)):
        lines.where(F.dayofmonth("ts") % 2 == odd).select("value").write.text(f"{folder}/in/{landing_no}")
        raw = refresh.load_feed(spark, "moer", f"{folder}/in/*", f"{folder}/raw")
    return raw.drop("extracted_at", "load_period")


@query
def stream_upsert(spark, sf):
    """The stream is merged, then offered again from the start; the table must not change."""
    folder = work_folder(spark, "stream_upsert")
    for attempt in ("first", "again"):
        raw = testbed.moer_raw_from(testbed.event_stream(spark, sf)).withColumn(
            "point_day", F.to_date("point_time")
        )
        run_upsert(
            raw, f"{folder}/table", f"{folder}/checkpoint-{attempt}",
            keys=["ba", "point_time"], partition_by=["point_day"],
        ).awaitTermination()
    return spark.read.schema(raw.schema).parquet(f"{folder}/table")


# --- data quality ------------------------------------------------------------------------


def _labelled(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(F.lit(table).alias("table_name"), "*")


@query
def dq_not_null(spark, sf):
    checks = [
        ("grid_intensity_daily", daily(spark, sf),
         ["grid_region", "timestamp_day", "avg_carbon_intensity", "distinct_hours", "stddev_carbon_intensity"]),
        ("raw_grid", testbed.grid_raw(spark, sf), ["id", "timestamp"]),
        ("raw_moer", testbed.moer_raw(spark, sf), ["id", "point_time"]),
        ("raw_native", testbed.native_raw(spark, sf), ["id", "usage_month", "total_kgco2e"]),
        ("raw_ccf", testbed.raw_ccf(spark, sf), ["id", "usage_date"]),
    ]
    return reduce(
        DataFrame.unionByName,
        [_labelled(quality.not_null(rows, columns), name) for name, rows, columns in checks],
    )


@query
def dq_unique(spark, sf):
    checks = [
        ("fact_cloud_carbon", cloud_fact(spark, sf), "id"),
        ("raw_ccf", testbed.raw_ccf(spark, sf), "id"),
        ("raw_grid", testbed.grid_raw(spark, sf), "id"),
        ("dim_grid_regions", testbed.region_dim(spark, sf), "grid_region"),
    ]
    return reduce(
        DataFrame.unionByName,
        [_labelled(quality.unique(rows, column), name) for name, rows, column in checks],
    )


@query
def dq_suite(spark, sf):
    """The declared checks of all raw, staging and mart tables.

    Monthly reports, staged estimates and the grid fact are computed once and stored, as many models derive from them.
    """

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = work_folder(spark, f"dq_suite-{name}")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    native = stored(testbed.native_raw(spark, sf), "native")
    raw = {
        **testbed.native_feeds(native),
        "ccf": testbed.raw_ccf(spark, sf), "grid": testbed.grid_raw(spark, sf), "moer": testbed.moer_raw(spark, sf),
    }
    stage = {"gcp": staging.stage_gcp, "aws": staging.stage_aws, "azure": staging.stage_azure, "grid": staging.stage_grid, "moer": staging.stage_moer}
    staged = {
        **{feed: stage[feed](raw[feed]) for feed in stage},
        "ccf": stored(staging.stage_ccf(raw["ccf"]), "stg_ccf"),
    }
    fact = emissions.fact_cloud_carbon([staging.stage_native(native, F.col("cloud_provider"))], staged["ccf"])
    readings = stored(grid_fact(spark, sf), "fact_grid_intensity")
    return quality.suite({
        **{f"raw_{feed}": rows for feed, rows in raw.items()},
        **{f"stg_{feed}": rows for feed, rows in staged.items()},
        "fact_cloud_carbon": fact,
        "carbon_trends_monthly": emissions.carbon_trends(fact, ordered=False),
        "fact_grid_intensity": readings,
        "grid_intensity_daily": grid.grid_intensity_daily(readings),
        "dim_grid_regions": testbed.region_dim(spark, sf),
    })


@query
def dq_expression(spark, sf):
    rules = {
        **quality.daily_rules(),
        "is_complete_day": F.col("is_complete_day"),
        "stddev < 100": F.col("stddev_carbon_intensity") < 100,
    }
    return quality.expression_is_true(daily(spark, sf), rules)


@query
def dq_violations(spark, sf):
    """The failing rows of two rules, as they would be stored."""
    rules = {
        "is_complete_day": F.col("is_complete_day"),
        "stddev < 100": F.col("stddev_carbon_intensity") < 100,
    }
    return quality.violations(daily(spark, sf), rules).select(
        "grid_region", "timestamp_day", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query
def dq_schema(spark, sf):
    """The daily table is offered in the model's names, which the dashboards' contract rejects."""
    tables = {
        "fact_grid_intensity": grid_fact(spark, sf),
        "fact_cloud_carbon": cloud_fact(spark, sf),
        "grid_intensity_daily": daily(spark, sf),
        "dim_grid_regions": testbed.region_dim(spark, sf),
        "carbon_trends_monthly": trends(spark, sf),
    }
    return quality.schema_report(tables, REQUIRED_COLUMNS)


@query
def dq_range(spark, sf):
    fact = cloud_fact(spark, sf)
    tight = {"scope1_kgco2e": 100.0, "scope2_market_based_kgco2e": 2000.0, "scope3_kgco2e": 300.0}
    return _labelled(quality.scope_ranges(fact), "declared limits").unionByName(
        _labelled(quality.scope_ranges(fact, tight), "tight limits")
    )


@query
def dq_freshness(spark, sf):
    return quality.freshness(cloud_fact(spark, sf), F.lit(date(2002, 1, 15)))
