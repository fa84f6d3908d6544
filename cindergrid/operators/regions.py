"""Region metadata, region statistics and the datacenter-to-grid mapping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindergrid.functions.buckets import CLEANLINESS, INTENSITY, bucket
from cindergrid.operators.grid import day_states, mean_of_states

# Region rules in order; a code ending in % is a prefix. For each attribute the
# first matching rule that has a value for it wins; a dash means the rule has none.
#   codes | name | country | continent | time zone | type
REGION_RULES = """
CAISO, CISO, US-CAL-CISO|California ISO|United States|North America|America/Los_Angeles|ISO/RTO
ERCOT, US-TEX-ERCO|Texas (ERCOT)|-|-|America/Chicago|-
PJM, US-MIDA-PJM|PJM Interconnection|-|-|America/New_York|-
MISO, US-MIDW-MISO|Midcontinent ISO|-|-|-|-
NYISO, US-NY-NYIS|New York ISO|-|-|America/New_York|-
ISONE, US-NE-ISNE|ISO New England|-|-|America/New_York|-
SPP, US-CENT-SPP|Southwest Power Pool|-|-|-|-
ERCOT, PJM, MISO, NYISO, ISONE, SPP, US-%|-|United States|North America|-|ISO/RTO
IESO|Ontario (IESO)|Canada|North America|America/Toronto|ISO/RTO
AESO|Alberta|Canada|North America|-|ISO/RTO
BC|British Columbia|Canada|North America|-|Utility
SaskPower|Saskatchewan|Canada|North America|-|Utility
DE%|Germany|Germany|Europe|Europe/Berlin|-
FR%|France|France|Europe|Europe/Paris|-
GB%|United Kingdom|United Kingdom|Europe|Europe/London|-
ES%|Spain|Spain|Europe|-|-
IT%|Italy|Italy|Europe|-|-
NL%|Netherlands|Netherlands|Europe|-|-
SE%|Sweden|Sweden|Europe|-|-
NO%|Norway|Norway|Europe|-|-
DK%|Denmark|Denmark|Europe|-|-
"""
ATTRIBUTES = ("region_name", "country", "continent", "timezone", "region_type")


def region_rules() -> list[tuple[list[str], dict[str, str]]]:
    """The rules as (codes, attribute -> value); attributes without a value are left out."""
    rules = []
    for line in REGION_RULES.strip().splitlines():
        codes, *values = line.split("|")
        named = {name: value for name, value in zip(ATTRIBUTES, values) if value != "-"}
        rules.append((codes.split(", "), named))
    return rules


def _matches(code: Column, codes: list[str]) -> Column:
    exact = [c for c in codes if not c.endswith("%")]
    test = code.isin(exact) if exact else F.lit(False)
    for prefix in (c[:-1] for c in codes if c.endswith("%")):
        test = test | code.startswith(prefix)
    return test


def region_metadata(code: Column) -> dict[str, Column]:
    """The five attributes as expressions over the region code: a projection, not a join."""
    fallback = {
        "region_name": code,
        "country": F.lit("Unknown"),
        "continent": F.lit("Other"),
        "timezone": F.lit(None).cast("string"),
        "region_type": F.lit("Grid Zone"),
    }
    result = {}
    for name in ATTRIBUTES:
        expression = fallback[name]
        for codes, values in reversed(region_rules()):
            if name in values:
                expression = F.when(_matches(code, codes), values[name]).otherwise(expression)
        result[name] = expression
    return result


def with_region_metadata(rows: DataFrame, code: str = "grid_region") -> DataFrame:
    return rows.withColumns(region_metadata(F.col(code)))


def stats_of_states(states: DataFrame) -> DataFrame:
    """Coverage and intensity statistics per region from the states of its days."""
    return states.groupBy("grid_region").agg(
        F.min("timestamp_day").alias("first_data_date"),
        F.max("timestamp_day").alias("last_data_date"),
        F.count("timestamp_day").alias("days_of_data"),
        mean_of_states("intensity").alias("avg_carbon_intensity"),
        F.min("intensity_min").alias("min_carbon_intensity"),
        F.max("intensity_max").alias("max_carbon_intensity"),
        mean_of_states("renewable").alias("avg_renewable_percentage"),
    )


def region_stats(fact: DataFrame) -> DataFrame:
    """The statistics straight from the fact, in one pass."""
    return stats_of_states(day_states(fact))


_STATS = [
    "first_data_date", "last_data_date", "days_of_data", "avg_carbon_intensity",
    "min_carbon_intensity", "max_carbon_intensity", "avg_renewable_percentage",
]


def dim_of_stats(stats: DataFrame) -> DataFrame:
    """Every region with metadata, statistics and cleanliness.

    The statistics already hold one row per region and the metadata is a projection, so no
    join is needed. A NULL region keeps its row; nothing is known about it.
    """
    known = F.col("grid_region").isNotNull()
    metadata = region_metadata(F.col("grid_region"))
    average = F.when(known, F.col("avg_carbon_intensity"))
    return stats.select(
        "grid_region",
        *[F.when(known, expression).alias(name) for name, expression in metadata.items()],
        *[F.when(known, F.col(name)).alias(name) for name in _STATS],
        bucket(average, CLEANLINESS).alias("cleanliness_category"),
        F.lit(None).cast("double").alias("pue"),
        F.lit(None).cast("double").alias("wue"),
        F.lit(None).cast("double").alias("cfe_percent"),
        F.lit(None).cast("string").alias("grid_zone_id"),
    )


def dim_grid_regions(fact: DataFrame) -> DataFrame:
    return dim_of_stats(region_stats(fact))


def labelled(stats: DataFrame) -> DataFrame:
    """The statistics with the cleanliness label, as a side table next to a static dimension."""
    return stats.withColumn("cleanliness_category", bucket(F.col("avg_carbon_intensity"), CLEANLINESS))


def region_stats_table(fact: DataFrame) -> DataFrame:
    return labelled(region_stats(fact))


def with_stats(seed: DataFrame, stats: DataFrame) -> DataFrame:
    """The static dimension with what the readings say about each region; unread regions stay."""
    return seed.join(labelled(stats), "grid_region", "left")


def seed_with_stats(seed: DataFrame, fact: DataFrame) -> DataFrame:
    return with_stats(seed, region_stats(fact))


# Which dimension column lists the regions of which provider.
PROVIDER_LISTS = {"GCP": "gcp_regions", "AWS": "aws_regions", "Azure": "azure_regions"}


def datacenter_regions(dim: DataFrame) -> DataFrame:
    """One row per (grid region, provider, datacenter region) from the comma lists.

    The providers are an array of (name, list) pairs that is exploded, kept where the
    region's provider list names them, and split: no join with a provider table.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(provider).alias("cloud_provider"), F.col(column).alias("regions"))
            for provider, column in PROVIDER_LISTS.items()
        ]
    )
    serves = F.col("cloud_providers").contains(F.col("pair.cloud_provider"))
    return (
        dim.withColumn("pair", F.explode(pairs))
        .where(serves)
        .withColumn("cloud_provider", F.col("pair.cloud_provider"))
        .withColumn("datacenter_region", F.explode(F.split("pair.regions", ",")))
        .withColumn("datacenter_region", F.trim("datacenter_region"))
        .where(F.col("datacenter_region") != "")
        .drop("pair")
    )


def spelled_alike(region: Column) -> Column:
    """Optional join spelling: ``East US`` and ``eastus`` meet."""
    return F.lower(F.replace(region, F.lit(" "), F.lit("")))


def datacenter_with_grid(
    dim: DataFrame,
    daily: DataFrame,
    fact_cloud: DataFrame,
    spelling: Callable[[Column], Column] = lambda region: region,
) -> DataFrame:
    """Datacenter regions with the intensity of their grid and the emissions reported there.

    Both facts are aggregated before they are joined, so the joins see one row per region.
    A datacenter listed under two grid regions repeats its emissions: do not sum the result.
    """
    intensity = daily.groupBy("grid_region").agg(
        F.avg("avg_carbon_intensity").alias("grid_avg_intensity")
    ).withColumn("cleanliness_category", bucket(F.col("grid_avg_intensity"), INTENSITY))
    emissions = (
        fact_cloud.where(F.col("region").isNotNull())
        .groupBy("cloud_provider", spelling(F.col("region")).alias("spelled"))
        .agg(F.sum("total_mtco2e").alias("reported"))
    )
    return (
        # A stored dimension has a label of its own, over all its readings.
        datacenter_regions(dim.drop("cleanliness_category"))
        .withColumn("spelled", spelling(F.col("datacenter_region")))
        .join(intensity, "grid_region", "left")
        .join(emissions, ["cloud_provider", "spelled"], "left")
        .select(
            "cloud_provider",
            "datacenter_region",
            "grid_region",
            F.col("region_name").alias("grid_region_name"),
            "country",
            "grid_avg_intensity",
            "cleanliness_category",
            F.coalesce("reported", F.lit(0.0)).alias("total_emissions_mtco2e"),
            "latitude",
            "longitude",
        )
        .orderBy(
            F.desc("total_emissions_mtco2e"), "cloud_provider", "datacenter_region", "grid_region"
        )
    )
