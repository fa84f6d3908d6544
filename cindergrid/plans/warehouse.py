"""Building the marts in dependency order and storing them as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindergrid.functions.time import stamped
from cindergrid.operators import emissions, grid, regions, staging
from cindergrid.operators.upsert import as_replaced, finish_pending, has_folder, is_pending, move_in, stage_replacement, write_partitioned
from cindergrid.sources import seed
from cindergrid.sources.cursors import from_month, in_months

# Month columns: a query for a month range reads only those folders.
PARTITIONED_BY = {
    "fact_cloud_carbon": ["usage_month_start"],
    "fact_grid_intensity": ["timestamp_month"],
    "grid_intensity_daily": ["timestamp_month"],
    "grid_day_states": ["timestamp_month"],
    "carbon_monthly": ["month"],
}
MONTH_TYPE = {name: "date" if name in ("fact_cloud_carbon", "carbon_monthly") else "timestamp_ntz" for name in PARTITIONED_BY}
MARTS = (
    *PARTITIONED_BY, "carbon_trends_monthly", "grid_intensity_weekly", "grid_intensity_monthly",
    "dim_grid_regions", "dim_grid_regions_derived", "dim_grid_regions_stats",
)

CLOUD_FEEDS = {"gcp", "aws", "azure", "ccf"}
GRID_FEEDS = {"grid", "moer"}


def build_cloud_fact(raw: Mapping[str, DataFrame]) -> DataFrame:
    """From the raw provider tables that are present (gcp, aws, azure, ccf)."""
    stage = {"gcp": staging.stage_gcp, "aws": staging.stage_aws, "azure": staging.stage_azure}
    native = [stage[feed](raw[feed]) for feed in stage if feed in raw]
    ccf = staging.stage_ccf(raw["ccf"]) if "ccf" in raw else None
    return emissions.fact_cloud_carbon(native, ccf)


def build_grid_fact(raw: Mapping[str, DataFrame]) -> DataFrame:
    """From the raw readings that are present (grid, moer)."""
    average = grid.grid_hourly(staging.stage_grid(raw["grid"])) if "grid" in raw else None
    marginal = grid.moer_hourly(staging.stage_moer(raw["moer"])) if "moer" in raw else None
    return grid.fact_grid_intensity(average, marginal)


def _staging(folder: str, name: str) -> str:
    return f"{folder}/{name}-next"


def store(
    spark: SparkSession, table: DataFrame, folder: str, name: str, replace_all: bool = True, touched: DataFrame | None = None
) -> DataFrame:
    """Write a mart and return it read back, so later marts scan columns, not lineage.

    The rows are written whole beside the mart and marked, then moved in; a build that dies on the way
    leaves the old mart, or a marked one that the next build completes and ``open_mart`` sees already.
    With ``touched`` (values of the partition column) only these partitions are replaced, and
    those that get no rows go; without it and with ``replace_all`` off, those that get rows.
    """
    path, staging = f"{folder}/{name}", _staging(folder, name)
    table = stamped(table)
    by = PARTITIONED_BY.get(name, [])
    finish_pending(spark, path, staging, table.schema, by)
    if by and touched is None and not replace_all:
        write_partitioned(table, path, by)
    else:
        stage_replacement(table, staging, by, touched if by else None)
        move_in(spark, path, staging, table.schema, by)
    return spark.read.schema(table.schema).parquet(path).select(*table.columns)


def open_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored mart, whole also while it is being replaced.

    A partition folder's timestamp reads back zoned; all marts are zone-less.
    """
    path, staging = f"{folder}/{name}", _staging(folder, name)
    if is_pending(spark, staging):
        schema = _zoneless(spark.read.parquet(f"{staging}/merged")).schema
        table = as_replaced(spark, path, staging, schema, PARTITIONED_BY.get(name, []))
    else:
        table = spark.read.parquet(path)
    return _zoneless(table)


def _zoneless(table: DataFrame) -> DataFrame:
    zoned = [f.name for f in table.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def open_marts(spark: SparkSession, folder: str, names: Collection[str] | None = None) -> dict[str, DataFrame]:
    """The marts that are stored, by name."""
    wanted = MARTS if names is None else names
    return {n: open_mart(spark, folder, n) for n in wanted if has_folder(spark, f"{folder}/{n}") or is_pending(spark, _staging(folder, n))}


def build_marts(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    since: date | None = None,
    months: Mapping[str, Collection[date]] | None = None,
) -> dict[str, DataFrame]:
    """Facts first, then what derives from them; each mart is computed and stored once.

    With ``since`` the month-partitioned marts are rebuilt from that month on and keep their
    older partitions. With ``months`` (by side, ``cloud`` and ``grid``) exactly these are rebuilt, and those
    that come out empty go; a side without months is not built. The facts, the daily mart and the monthly states are
    partitioned by month, so a run reads and writes the months that it is asked for. The other marts derive from
    the states, which hold a row per region and day or per account and month.
    """
    marts: dict[str, DataFrame] = {}
    cloud, readings = bool(raw.keys() & CLOUD_FEEDS), bool(raw.keys() & GRID_FEEDS)
    if months is not None:
        cloud, readings = cloud and bool(months.get("cloud")), readings and bool(months.get("grid"))
    scope = _Scope(spark, folder, since, months)

    def keep(name: str, table: DataFrame, side: str) -> DataFrame:
        marts[name] = store(spark, table, folder, name, touched=scope.touched(name, side))
        return marts[name]

    if cloud:
        fact = keep("fact_cloud_carbon", build_cloud_fact(scope.raw(raw, CLOUD_FEEDS, "cloud")), "cloud")
        monthly = emissions.monthly_emissions(scope.fresh(fact, "fact_cloud_carbon", "cloud"))
        monthly = keep("carbon_monthly", monthly, "cloud")
        keep("carbon_trends_monthly", emissions.trends_of_months(monthly.drop("processed_at")), "cloud")
    if readings:
        fact = keep("fact_grid_intensity", build_grid_fact(scope.raw(raw, GRID_FEEDS, "grid")), "grid")
        fresh = scope.fresh(fact, "fact_grid_intensity", "grid")
        keep("grid_intensity_daily", grid.grid_intensity_daily(fresh), "grid")
        states = keep("grid_day_states", grid.day_states(fresh), "grid").drop("processed_at")
        keep("grid_intensity_weekly", grid.rollup_of_states(states, "week"), "grid")
        keep("grid_intensity_monthly", grid.rollup_of_states(states, "month"), "grid")
        # What dashboards join: the static regions with coordinates and provider lists, and statistics.
        stats = regions.stats_of_states(states)
        keep("dim_grid_regions", regions.with_stats(seed.seed_grid_regions(spark), stats), "grid")
        keep("dim_grid_regions_derived", regions.dim_of_stats(stats), "grid")
        keep("dim_grid_regions_stats", regions.labelled(stats), "grid")
    return marts


class _Scope:
    """The months that a build covers: all, those from one on, or given ones."""

    def __init__(self, spark: SparkSession, folder: str, since: date | None, months: Mapping[str, Collection[date]] | None):
        self.spark, self.folder, self.months = spark, folder, months
        self.since = since.replace(day=1) if since else None
        self.whole = since is None and months is None

    def raw(self, raw: Mapping[str, DataFrame], feeds: set[str], side: str) -> dict[str, DataFrame]:
        rows = {feed: table for feed, table in raw.items() if feed in feeds}
        if self.months is not None:
            return {feed: in_months(table, feed, self.months[side]) for feed, table in rows.items()}
        return rows if self.whole else {feed: from_month(table, feed, self.since) for feed, table in rows.items()}

    def covers(self, month: Column, kind: str, side: str) -> Column:
        """Whether a value of a month column belongs to the scope; literals, so partitions are pruned."""
        if self.months is not None:
            return month.isin([F.lit(m).cast(kind) for m in self.months[side]])
        return F.lit(True) if self.whole else month >= F.lit(self.since).cast(kind)

    def fresh(self, fact: DataFrame, name: str, side: str) -> DataFrame:
        month = PARTITIONED_BY[name][0]
        return fact if self.whole else fact.where(self.covers(F.col(month), fact.schema[month].dataType.simpleString(), side))

    def touched(self, name: str, side: str) -> DataFrame | None:
        """The partitions of a mart that the build stands for, None for all of them."""
        if self.whole or name not in PARTITIONED_BY:
            return None
        month, kind = PARTITIONED_BY[name][0], MONTH_TYPE[name]
        if self.months is not None:
            given = self.spark.createDataFrame([(m,) for m in self.months[side]], f"{month} date")
            return given.select(F.col(month).cast(kind).alias(month))
        # From a month on: what is stored there now; what arrives anew is no question.
        if not has_folder(self.spark, f"{self.folder}/{name}"):
            return self.spark.createDataFrame([], f"{month} {kind}")
        stored = open_mart(self.spark, self.folder, name).select(F.col(month).cast(kind).alias(month))
        return stored.where(self.covers(F.col(month), kind, side)).distinct()


def dashboard_tables(marts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts as dashboards name them: the daily mart is the same table with other column names."""
    tables = dict(marts)
    if "grid_intensity_daily" in tables:
        tables["grid_intensity_daily"] = grid.daily_for_dashboards(marts["grid_intensity_daily"])
    return tables


def backup(spark: SparkSession, folder: str, name: str, now: datetime | None = None) -> str:
    """Copy a stored mart aside before its columns change; returns the copy's path."""
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S")
    copy = f"{folder}/{name}_backup_{stamp}"
    open_mart(spark, folder, name).write.mode("error").parquet(copy)
    return copy
