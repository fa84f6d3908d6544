"""Parametric queries over the marts, as functions that return DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cindergrid.functions.buckets import bucket
from cindergrid.functions.measures import KG_PER_TONNE
from cindergrid.functions.time import start_of
from cindergrid.operators.staging import GRID_SOURCE, MARGINAL_SOURCE
from cindergrid.plans import guard

# Accepted filters and default row limits.
PROVIDERS = ("GCP", "AWS", "Azure")
SOURCES = (GRID_SOURCE, MARGINAL_SOURCE)
ROW_LIMIT = 1000
TREND_LIMIT = 12


def _choice(value: str | None, allowed: tuple[str, ...], what: str) -> str | None:
    """None stands for "all"."""
    if value is None or value == "all":
        return None
    if value not in allowed:
        raise ValueError(f"{what} must be 'all' or one of {allowed}, not {value!r}")
    return value


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows; all of them for None."""
    if limit is None:
        return rows
    if limit < 1:
        raise ValueError(f"limit must be at least 1, not {limit}")
    return rows.limit(limit)


def _containing(text: str) -> str:
    """ILIKE pattern; % and _ inside the text stay wildcards, a backslash is literal."""
    return "%" + text.replace("\\", "\\\\") + "%"


def _provider_and_months(
    fact: DataFrame, provider: str | None, start_month: date | None, end_month: date | None
) -> DataFrame:
    chosen = _choice(provider, PROVIDERS, "provider")
    if chosen:
        fact = fact.where(F.col("cloud_provider") == chosen)
    if start_month:
        fact = fact.where(F.col("usage_month_start") >= F.lit(start_month))
    if end_month:
        fact = fact.where(F.col("usage_month_start") <= F.lit(end_month))
    return fact


def cloud_emissions(
    fact: DataFrame,
    provider: str | None = None,
    start_month: date | None = None,
    end_month: date | None = None,
    account_id: str | None = None,
    service_name: str | None = None,
    region: str | None = None,
    limit: int | None = ROW_LIMIT,
) -> DataFrame:
    """Emission rows under optional filters, newest and largest first.

    On the stored fact the month bounds prune partitions and the other filters reach the
    scan; sort and limit become one top-k per task instead of a global sort.
    """
    rows = _provider_and_months(fact, provider, start_month, end_month)
    if account_id:
        rows = rows.where(F.col("account_id") == account_id)
    if service_name:
        rows = rows.where(F.col("service_name").ilike(_containing(service_name)))
    if region:
        rows = rows.where(F.col("region") == region)
    ordered = (
        rows.select(
            "id", "cloud_provider", "account_id", "service_name", "region", "usage_month_start",
            "scope1_kgco2e", "scope2_market_based_kgco2e", "scope3_kgco2e", "total_kgco2e",
            "total_mtco2e", "kgco2e_per_dollar", "kgco2e_per_kwh", "extracted_at",
        )
        .orderBy(F.desc_nulls_last("usage_month_start"), F.desc_nulls_last("total_kgco2e"), "id")
    )
    return _first(ordered, limit)


def cloud_summary(
    fact: DataFrame,
    provider: str | None = None,
    start_month: date | None = None,
    end_month: date | None = None,
) -> DataFrame:
    """Counts, sums, average and coverage per provider.

    Months collapse first, so the three distinct counts copy one row per account, service
    and region instead of every fact row.
    """
    scopes = {
        "scope1_mtco2e": "scope1_kgco2e",
        "scope2_mtco2e": "scope2_market_based_kgco2e",
        "scope3_mtco2e": "scope3_kgco2e",
    }
    rows = _provider_and_months(fact, provider, start_month, end_month)
    collapsed = rows.groupBy("cloud_provider", "account_id", "service_name", "region").agg(
        F.count("*").alias("records"),
        F.sum("total_mtco2e").alias("tonnes"),
        F.count("total_mtco2e").alias("measured"),
        *[F.sum(source).alias(name) for name, source in scopes.items()],
    )
    return (
        collapsed.groupBy("cloud_provider")
        .agg(
            F.sum("records").alias("record_count"),
            F.sum("tonnes").alias("total_mtco2e"),
            F.try_divide(F.sum("tonnes"), F.sum("measured")).alias("avg_mtco2e"),
            *[(F.sum(name) / KG_PER_TONNE).alias(name) for name in scopes],
            F.count_distinct("account_id").alias("num_accounts"),
            F.count_distinct("service_name").alias("num_services"),
            F.count_distinct("region").alias("num_regions"),
        )
        .orderBy(F.desc_nulls_last("total_mtco2e"), "cloud_provider")
    )


def grid_intensity(
    fact: DataFrame,
    region: str | None = None,
    source: str | None = None,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
    limit: int | None = ROW_LIMIT,
) -> DataFrame:
    """Hourly readings under optional filters, newest first.

    The time bounds are repeated on the month column, by which the stored fact is
    partitioned: that prunes whole folders.
    """
    rows = fact
    if region:
        rows = rows.where(F.col("grid_region").ilike(_containing(region)))
    chosen = _choice(source, SOURCES, "source")
    if chosen:
        rows = rows.where(F.col("data_source") == chosen)
    hour, month = F.col("timestamp_hour"), F.col("timestamp_month")
    if start_time:
        start = _naive(start_time)
        rows = rows.where((hour >= start) & (month >= start_of("month", start)))
    if end_time:
        end = _naive(end_time)
        rows = rows.where((hour <= end) & (month <= start_of("month", end)))
    ordered = (
        rows.select(
            "grid_region", "timestamp_hour", "carbon_intensity_gco2eq_per_kwh",
            "carbon_intensity_kgco2eq_per_kwh", "fossil_fuel_percentage", "renewable_percentage",
            "intensity_category", "data_source",
        )
        .orderBy(F.desc_nulls_last("timestamp_hour"), "grid_region", "data_source")
    )
    return _first(ordered, limit)


def _naive(moment: datetime) -> Column:
    """A zone-less literal; a zoned one would cast the column and block pushdown."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def current_grid_intensity(fact: DataFrame, region: str | None = None) -> DataFrame:
    """The latest hour of each region; if both sources report it, both rows stay.

    One pass: each task keeps one row of fixed width per region and source, the values at its
    newest hour. The window then compares the sources of a region, a handful of rows, never its
    history. A region, hour and source occur once in the fact, so nothing is lost.
    """
    rows = fact.where(F.col("grid_region").ilike(_containing(region))) if region else fact
    hour = F.col("timestamp_hour")
    measures = ["carbon_intensity_gco2eq_per_kwh", "fossil_fuel_percentage", "renewable_percentage"]
    newest = rows.groupBy("grid_region", "data_source").agg(
        F.max(hour).alias("timestamp_hour"), *[F.max_by(m, hour).alias(m) for m in measures]
    )
    last = F.max("timestamp_hour").over(Window.partitionBy("grid_region"))
    return (
        newest.withColumn("last", last)
        .where("timestamp_hour = last")
        .select(
            "grid_region", "timestamp_hour", "carbon_intensity_gco2eq_per_kwh",
            bucket(F.col("carbon_intensity_gco2eq_per_kwh")).alias("intensity_category"),
            "fossil_fuel_percentage", "renewable_percentage", "data_source",
        )
        .orderBy(
            F.desc_nulls_last("carbon_intensity_gco2eq_per_kwh"), "grid_region", "data_source"
        )
    )


def trend_rows(
    trends: DataFrame,
    provider: str | None = None,
    account_id: str | None = None,
    limit: int | None = TREND_LIMIT,
) -> DataFrame:
    """Newest trend rows in tonnes. ``limit`` counts rows, not months."""
    rows = trends
    chosen = _choice(provider, PROVIDERS, "provider")
    if chosen:
        rows = rows.where(F.col("cloud_provider") == chosen)
    if account_id:
        rows = rows.where(F.col("account_id") == account_id)
    ordered = (
        rows.select(
            "month", "cloud_provider", "account_id", "total_mtco2e", "scope1_percent",
            "scope2_percent", "scope3_percent", "mom_change_percent",
            (F.col("rolling_3mo_avg_kgco2e") / KG_PER_TONNE).alias("rolling_3mo_avg_mtco2e"),
            (F.col("ytd_total_kgco2e") / KG_PER_TONNE).alias("ytd_total_mtco2e"),
            "trend_indicator", "kgco2e_per_dollar",
        )
        .orderBy(F.desc("month"), "cloud_provider", "account_id")
    )
    return _first(ordered, limit)


# The session's list of views that ad-hoc SQL may read.
VIEWS = "cindergrid.views"
#: What one ad-hoc query may read: 1 TiB.
MOST_BYTES = 1 << 40


def register_views(marts: Mapping[str, DataFrame]) -> None:
    """Name the marts for :func:`ad_hoc`."""
    for name, table in marts.items():
        table.createOrReplaceTempView(name)
        conf = table.sparkSession.conf
        known = set(conf.get(VIEWS, "").split(","))
        conf.set(VIEWS, ",".join(sorted(known | {name.lower()} - {""})))


def ad_hoc(spark: SparkSession, query: str, most_bytes: int | None = MOST_BYTES) -> DataFrame:
    """Run a read-only query over the registered views.

    The text is parsed as it stands, and every part of it must be on the lists of :mod:`cindergrid.plans.guard`
    before Spark sees it: no command, script, file, table or Java method, whatever form it comes in. Joins
    need equal keys, and a query that would scan more than ``most_bytes`` is refused. Words
    such as ``created_at`` and a leading WITH are fine.
    """
    text = query.strip().rstrip(";")
    views = set(spark.conf.get(VIEWS, "").split(",")) - {""}
    guard.require_query(spark, text, views)
    rows = spark.sql(text)
    guard.require_views(rows, views)
    guard.require_bounded(rows, most_bytes)
    return rows


def as_text(rows: DataFrame, form: str = "json") -> DataFrame:
    """Rows as lines of text, ``json`` objects or ``csv`` fields, to be written or streamed."""
    if form not in ("json", "csv"):
        raise ValueError(f"form must be 'json' or 'csv', not {form!r}")
    record = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    line = F.to_json(record, {"ignoreNullFields": "false"}) if form == "json" else F.to_csv(record, {"escape": '"'})
    return rows.select(line.alias("value"))


def records(rows: DataFrame, limit: int | None = ROW_LIMIT) -> dict:
    """``{"count", "data"}`` as the service returned it; never more than the limit is fetched."""
    data = [row.asDict(recursive=True) for row in _first(rows, limit).toLocalIterator()]
    return {"count": len(data), "data": data}
