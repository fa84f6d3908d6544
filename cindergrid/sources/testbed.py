"""The driver's star-schema tables seen as carbon and grid feeds.

Only these adapters know the test tables; every operator works on the shapes they return.
Joins carry no broadcast hints: Spark broadcasts a side it measures below its threshold and
otherwise sorts and merges, splitting hot keys at run time.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.functions.measures import (
    KG_PER_POUND,
    KG_PER_TONNE,
    joined_id,
    pounds_per_mwh_to_kg_per_kwh,
)
from cindergrid.functions.time import iso_utc, month_of
from cindergrid.sources.landing import parse_landing

PROVIDER_OF_FLAG = {"A": "AWS", "N": "GCP", "R": "Azure"}
ZONES = [
    "CAISO", "US-TEX-ERCO", "PJM", "IESO", "BC", "DE", "FR", "GB", "SE-1", "NYISO", "AESO", "XX",
]
GRID_EVENTS = ["view", "click", "purchase"]
MARGINAL_EVENTS = ["signup", "error"]


_tables: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of a table. Kept as long as its session: listing files and reading a footer costs a job."""
    known, path = _tables.setdefault(spark, {}), f"{sf_dir}/{name}.parquet"
    if path not in known:
        known[path] = spark.read.parquet(path)
    return known[path]


# --- emissions ---------------------------------------------------------------------------


def emission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One emission record per lineitem; ``feed`` F marks native reports, O daily estimates.

    A filter on the feed moves down to the lineitem scan, so the native and the estimate
    branch of a query each shuffle their own rows only. Every join adds one stored table,
    whose size Spark knows: joining supplier and nation to each other first would hide it and
    make the planner take lineitem for the small side.
    """
    parts = testbed_columns(spark, sf_dir, "part", l_partkey="p_partkey", service_name="p_type")
    orders = testbed_columns(
        spark, sf_dir, "orders", l_orderkey="o_orderkey", priority="o_orderpriority"
    )
    suppliers = testbed_columns(
        spark, sf_dir, "supplier", l_suppkey="s_suppkey", nation="s_nationkey"
    )
    nations = testbed_columns(spark, sf_dir, "nation", nation="n_nationkey", region="n_name")
    provider = prefix = F.lit(None).cast("string")
    for flag, name in PROVIDER_OF_FLAG.items():
        provider = F.when(F.col("l_returnflag") == flag, name).otherwise(provider)
        prefix = F.when(F.col("l_returnflag") == flag, f"{name.lower()}-").otherwise(prefix)
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, "l_suppkey")
        .join(nations, "nation")
        .join(parts, "l_partkey")
        .join(orders, "l_orderkey")
        .select(
            F.col("l_linestatus").alias("feed"),
            provider.alias("cloud_provider"),
            F.concat(prefix, "priority").alias("account_id"),
            "service_name",
            "region",
            F.to_date("l_shipdate").alias("usage_date"),
            F.col("l_quantity").alias("scope1_kgco2e"),
            (price / 100).alias("scope2_location_based_kgco2e"),
            (price * (1 - F.col("l_discount")) / 100).alias("scope2_market_based_kgco2e"),
            (F.col("l_tax") * 1000).alias("scope3_kgco2e"),
            (F.col("l_quantity") * 10).alias("kilowatt_hours"),
            price.alias("cost_usd"),
            F.col("l_shipdate").alias("extracted_at"),
        )
    )


def testbed_columns(spark: SparkSession, sf_dir: str, name: str, **columns: str) -> DataFrame:
    return table(spark, sf_dir, name).select(*[F.col(c).alias(a) for a, c in columns.items()])


def native_monthly(lines: DataFrame) -> DataFrame:
    """The three providers' monthly reports, with ids and location-based totals."""
    key = ["cloud_provider", "account_id", "service_name", "region"]
    scopes = [
        "scope1_kgco2e", "scope2_location_based_kgco2e", "scope2_market_based_kgco2e", "scope3_kgco2e",
    ]
    month = F.when(
        F.col("cloud_provider") == "GCP", F.date_format("usage_month", "yyyy-MM")
    ).otherwise(F.date_format("usage_month", "yyyy-MM-dd"))
    total = (
        F.col("scope1_kgco2e") + F.col("scope2_location_based_kgco2e") + F.col("scope3_kgco2e")
    )
    return (
        lines.where(F.col("feed") == "F")
        .groupBy(*key, month_of(F.col("usage_date")).alias("usage_month"))
        .agg(*[F.sum(s).alias(s) for s in scopes], F.max("extracted_at").alias("extracted_at"))
        .withColumns(
            {
                "id": joined_id(F.col("account_id"), F.col("service_name"), F.col("region"), month),
                "total_kgco2e": total,
            }
        )
    )


def native_raw(spark: SparkSession, sf_dir: str, provider: str | None = None) -> DataFrame:
    """Native reports of one provider, or of all three in one pass."""
    lines = emission_lines(spark, sf_dir)
    if provider:
        lines = lines.where(F.col("cloud_provider") == provider)
    return native_monthly(lines)


def _gcp(native: DataFrame) -> DataFrame:
    return native.withColumnsRenamed(
        {"account_id": "project_id", "service_name": "service_description", "region": "location_region"}
    )


def _azure(native: DataFrame) -> DataFrame:
    return native.withColumnRenamed("account_id", "subscription_id")


def raw_gcp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gcp(native_raw(spark, sf_dir, "GCP"))


def raw_aws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return native_raw(spark, sf_dir, "AWS")


def raw_azure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _azure(native_raw(spark, sf_dir, "Azure"))


def native_feeds(native: DataFrame) -> dict[str, DataFrame]:
    """The raw tables of the three providers, from the reports of all."""
    of = lambda provider: native.where(F.col("cloud_provider") == provider)
    return {"gcp": _gcp(of("GCP")), "aws": of("AWS"), "azure": _azure(of("Azure"))}


def ccf_daily(lines: DataFrame) -> DataFrame:
    """Daily estimates, one row per line."""
    scope1, scope3 = F.col("scope1_kgco2e"), F.col("scope3_kgco2e")
    scope2 = F.col("scope2_location_based_kgco2e")
    return lines.where(F.col("feed") == "O").select(
        joined_id(
            *[F.col(c) for c in ("cloud_provider", "account_id", "service_name", "region")],
            F.date_format("usage_date", "yyyy-MM-dd"),
        ).alias("id"),
        "cloud_provider",
        "account_id",
        "service_name",
        "region",
        "usage_date",
        scope1.alias("scope1_kgco2e"),
        scope2.alias("scope2_kgco2e"),
        scope3.alias("scope3_kgco2e"),
        (scope1 + scope2 + scope3).alias("total_kgco2e"),
        "kilowatt_hours",
        "cost_usd",
        "extracted_at",
    )


def raw_ccf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ccf_daily(emission_lines(spark, sf_dir))


def landed_gcp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested table export."""
    return native_raw(spark, sf_dir, "GCP").select(
        F.struct(F.col("account_id").alias("id")).alias("project"),
        F.struct(F.col("service_name").alias("description")).alias("service"),
        F.struct("region").alias("location"),
        "usage_month",
        F.struct(
            F.col("scope1_kgco2e").alias("scope1"),
            F.struct(
                F.col("scope2_location_based_kgco2e").alias("location_based"),
                F.col("scope2_market_based_kgco2e").alias("market_based"),
            ).alias("scope2"),
            F.col("scope3_kgco2e").alias("scope3"),
        ).alias("carbon_footprint_kgCO2e"),
        "extracted_at",
    )


def tonnes_lines(native: DataFrame, factor: float = 1.0) -> DataFrame:
    """Provider reports as JSON text in tonnes: ``value`` and the ``usage_month`` it holds."""
    tonnes = lambda scope: F.col(scope) / KG_PER_TONNE * factor
    return native.select(
        F.to_json(
            F.struct(
                F.col("account_id").alias("AccountId"),
                F.date_format("usage_month", "yyyy-MM-dd").alias("Month"),
                F.col("service_name").alias("ServiceName"),
                F.col("region").alias("Region"),
                tonnes("scope1_kgco2e").alias("Scope1"),
                tonnes("scope2_location_based_kgco2e").alias("Scope2LocationBased"),
                tonnes("scope2_market_based_kgco2e").alias("Scope2MarketBased"),
                tonnes("scope3_kgco2e").alias("Scope3"),
            )
        ).alias("value"),
        "usage_month",
    )


def landed_tonnes(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """The same, parsed like a landed file."""
    return parse_landing(tonnes_lines(native_raw(spark, sf_dir, provider)).select("value"), "tonnes")


def landed_ccf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line as a daily record with a one-element estimate array, as JSON text."""
    estimate = F.struct(
        F.col("cloud_provider").alias("cloudProvider"),
        F.col("account_id").alias("accountId"),
        F.col("service_name").alias("serviceName"),
        "region",
        F.col("kilowatt_hours").alias("kilowattHours"),
        F.col("scope1_kgco2e").alias("scope1"),
        F.col("scope2_location_based_kgco2e").alias("scope2"),
        F.col("scope3_kgco2e").alias("scope3"),
        F.col("cost_usd").alias("cost"),
    )
    lines = emission_lines(spark, sf_dir).where(F.col("feed") == "O").select(
        F.to_json(
            F.struct(
                F.date_format("usage_date", "yyyy-MM-dd'T00:00:00.000Z'").alias("timestamp"),
                F.array(estimate).alias("serviceEstimates"),
            )
        ).alias("value")
    )
    return parse_landing(lines, "ccf")


# --- grid --------------------------------------------------------------------------------


def _pick(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def readings(events: DataFrame, kinds: list[str]) -> DataFrame:
    """Events as readings: zone, time, grams per kWh and the share in ``props``. Stateless."""
    slot = F.col("user_id") % len(ZONES)
    return events.where(F.col("event_type").isin(kinds)).select(
        _pick(ZONES, slot).alias("zone"),
        "ts",
        (F.col("value") * (1 + slot) * 1.1).alias("grams"),
        F.from_json("props", "k int")["k"].alias("share"),
    )


def grid_raw_from(events: DataFrame) -> DataFrame:
    rest = (100 - F.col("share")).cast("double")
    mix = F.create_map(
        F.lit("fossil"), F.col("share").cast("double"), F.lit("renewable"), rest
    )
    return readings(events, GRID_EVENTS).select(
        joined_id(F.col("zone"), iso_utc(F.col("ts"))).alias("id"),
        "zone",
        F.col("ts").alias("timestamp"),
        F.col("grams").alias("carbon_intensity_gco2eq_per_kwh"),
        F.col("share").cast("double").alias("fossil_fuel_percentage"),
        rest.alias("renewable_percentage"),
        rest.alias("low_carbon_percentage"),
        mix.alias("power_production_breakdown"),
        mix.alias("power_consumption_breakdown"),
        F.col("ts").alias("extracted_at"),
    )


def moer_raw_from(events: DataFrame) -> DataFrame:
    rate = F.col("grams") / KG_PER_POUND
    return readings(events, MARGINAL_EVENTS).select(
        joined_id(F.col("zone"), iso_utc(F.col("ts"))).alias("id"),
        F.col("zone").alias("ba"),
        F.col("zone").alias("ba_name"),
        F.col("ts").alias("point_time"),
        rate.alias("moer"),
        pounds_per_mwh_to_kg_per_kwh(rate).alias("moer_kgco2_per_kwh"),
        F.col("share").alias("percent"),
        F.lit(300).alias("frequency"),
        F.lit("RTM").alias("market"),
        F.col("ts").alias("extracted_at"),
    )


def grid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_raw_from(table(spark, sf_dir, "events"))


def moer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moer_raw_from(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream; as a pattern, because a plain path must be a folder there."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def landed_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = (100 - F.col("share")).cast("double")
    point = F.struct(
        F.date_format("ts", _INSTANT).alias("datetime"),
        F.col("grams").alias("carbonIntensity"),
        F.col("share").cast("double").alias("fossilFuelPercentage"),
        rest.alias("renewablePercentage"),
        rest.alias("lowCarbonPercentage"),
        F.create_map(
            F.lit("fossil"), F.col("share").cast("double"), F.lit("renewable"), rest
        ).alias("powerProductionBreakdown"),
    )
    events = table(spark, sf_dir, "events")
    lines = readings(events, GRID_EVENTS).select(
        F.to_json(F.struct("zone", F.array(point).alias("history"))).alias("value")
    )
    return parse_landing(lines, "grid")


def moer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines of the marginal feed: ``value`` and the ``ts`` it holds.

    Percentile only: name, frequency and market are left to the normaliser's defaults.
    """
    point = F.struct(
        F.date_format("ts", _INSTANT).alias("point_time"),
        (F.col("grams") / KG_PER_POUND).alias("value"),
        F.col("share").alias("percent"),
    )
    events = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.col("zone").alias("ba"), F.array(point).alias("data")))
    return readings(events, MARGINAL_EVENTS).select(line.alias("value"), "ts")


def landed_moer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_landing(moer_lines(spark, sf_dir), "moer")


# --- dimension ---------------------------------------------------------------------------


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation as a grid region: the first twelve carry the zone codes, the others their own.

    Nation k lists itself and nation k+12, so a datacenter region can lie in two grid regions.
    """
    key = F.col("n_nationkey")
    code = F.when(key < len(ZONES), _pick(ZONES, key % len(ZONES))).otherwise(
        F.concat(F.lit("ZONE-"), key.cast("string"))
    )
    pair = F.concat(
        F.lit("NATION_"), key.cast("string"), F.lit(", NATION_"), (key + 12).cast("string")
    )
    kind = key % 3

    def listed(*kinds: int) -> Column:
        return F.when(kind.isin(*kinds), pair).otherwise("")

    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            code.alias("grid_region"),
            F.col("n_name").alias("region_name"),
            F.concat(F.lit("City "), key.cast("string")).alias("city"),
            F.col("r_name").alias("country"),
            (key * 3.0 - 30).alias("latitude"),
            (key * 7.0 - 80).alias("longitude"),
            F.when(kind == 0, "GCP, AWS, Azure")
            .when(kind == 1, "GCP, Azure")
            .otherwise("AWS")
            .alias("cloud_providers"),
            listed(0, 1).alias("gcp_regions"),
            listed(0, 2).alias("aws_regions"),
            listed(0, 1).alias("azure_regions"),
        )
    )
