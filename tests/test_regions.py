import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from cindergrid.operators import regions
from cindergrid.sources.seed import SEED_SCHEMA, seed_grid_regions
from test_grid import fact_of


@pytest.mark.parametrize(
    ("code", "expected"),
    [
        ("CISO", ("California ISO", "United States", "North America", "America/Los_Angeles", "ISO/RTO")),
        ("US-TEX-ERCO", ("Texas (ERCOT)", "United States", "North America", "America/Chicago", "ISO/RTO")),
        ("MISO", ("Midcontinent ISO", "United States", "North America", None, "ISO/RTO")),
        ("US-NEW", ("US-NEW", "United States", "North America", None, "ISO/RTO")),
        ("IESO", ("Ontario (IESO)", "Canada", "North America", "America/Toronto", "ISO/RTO")),
        ("AESO", ("Alberta", "Canada", "North America", None, "ISO/RTO")),
        ("BC", ("British Columbia", "Canada", "North America", None, "Utility")),
        ("DE-LU", ("Germany", "Germany", "Europe", "Europe/Berlin", "Grid Zone")),
        ("SE-1", ("Sweden", "Sweden", "Europe", None, "Grid Zone")),
        ("XX", ("XX", "Unknown", "Other", None, "Grid Zone")),
    ],
)
def test_metadata(spark, code, expected):
    df = spark.createDataFrame([(code,)], "grid_region string")
    assert tuple(regions.with_region_metadata(df).first())[1:] == expected


def test_dim_keeps_null_region_without_facts(spark):
    fact = fact_of(
        spark,
        ("DE", "2024-01-01 00:00", 100.0, "a"),
        ("DE", "2024-01-02 00:00", 150.0, "a"),
        (None, "2024-01-01 00:00", 10.0, "a"),
    )
    german, unknown = regions.dim_grid_regions(fact).orderBy(F.col("grid_region").isNull()).collect()
    assert (german.region_name, german.days_of_data, german.cleanliness_category) == ("Germany", 2, "Very Clean")
    assert german.first_data_date == ts("2024-01-01") and german.pue is None
    assert unknown.country is None and unknown.days_of_data is None
    assert unknown.cleanliness_category == "Very Dirty"


def test_seed_with_stats(spark):
    fact = fact_of(spark, ("DE", "2024-01-01 00:00", 500.0, "a"))
    dim = regions.seed_with_stats(seed_grid_regions(spark), fact)
    assert dim.count() == 49
    assert rows(dim.where("cleanliness_category is not null"), "grid_region", "cleanliness_category") == [
        ("DE", "Dirty")
    ]


CLOUD = "cloud_provider string, region string, total_mtco2e double"
DAILY = "grid_region string, avg_carbon_intensity double"


def dim(spark, *values):
    """(code, providers, gcp, aws, azure)"""
    return spark.createDataFrame(
        [(c, c, None, "land", "LL", 1.0, 2.0, None, p, g, a, z) for c, p, g, a, z in values], SEED_SCHEMA
    )


def test_datacenter_with_grid(spark):
    places = dim(
        spark,
        ("IE", "GCP, AWS, Azure", "europe-west1", "eu-west-1", "North Europe"),
        ("BE", "GCP, Azure", "europe-west1,  europe-west9", "eu-west-1", ""),
        ("FL", "Azure", "", "", "Florida"),
    )
    daily = spark.createDataFrame([("IE", 90.0), ("IE", 130.0), ("BE", 400.0)], DAILY)
    cloud = spark.createDataFrame(
        [
            ("GCP", "europe-west1", 1.5), ("GCP", "europe-west1", 1.0), ("AWS", "eu-west-1", 4.0),
            ("Azure", "northeurope", 9.0), ("GCP", None, 100.0),
        ],
        CLOUD,
    )
    result = regions.datacenter_with_grid(places, daily, cloud)
    got = [
        tuple(r)
        for r in result.select(
            "cloud_provider", "datacenter_region", "grid_region", "grid_avg_intensity",
            "cleanliness_category", "total_emissions_mtco2e",
        ).collect()
    ]
    # A list entry without its provider is ignored, one region may lie in two grids, a grid
    # without readings has no category, and provider spellings only meet on request.
    assert got == [
        ("AWS", "eu-west-1", "IE", 110.0, "Low", 4.0),
        ("GCP", "europe-west1", "BE", 400.0, "High", 2.5),
        ("GCP", "europe-west1", "IE", 110.0, "Low", 2.5),
        ("Azure", "Florida", "FL", None, None, 0.0),
        ("Azure", "North Europe", "IE", 110.0, "Low", 0.0),
        ("GCP", "europe-west9", "BE", 400.0, "High", 0.0),
    ]
    alike = regions.datacenter_with_grid(places, daily, cloud, regions.spelled_alike)
    found = alike.where(F.col("datacenter_region") == "North Europe").first()
    assert found.total_emissions_mtco2e == 9.0


def test_null_provider_list(spark):
    places = dim(spark, ("IE", None, "a", "b", "c"), ("BE", "GCP", None, "b", "c"))
    assert regions.datacenter_regions(places).count() == 0
