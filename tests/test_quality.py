from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cindergrid.operators import quality


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", -1.0), ("b", None), (None, 5.0), (None, 6.0)], "id string, v double"
    )


def test_not_null(table):
    assert rows(quality.not_null(table, ["id", "v"])) == [("id", 2), ("v", 1)]


def test_unique(table):
    assert rows(quality.unique(table, "id")) == [("id", "a", 2)]


def test_expressions(table):
    rules = {"v >= 0": F.col("v") >= 0, "v < 100": F.col("v") < 100}
    assert rows(quality.expression_is_true(table, rules)) == [("v < 100", 0, 1), ("v >= 0", 1, 1)]
    failing = quality.violations(table, rules).collect()
    assert [(r.v, r.failed_rules) for r in failing] == [(-1.0, ["v >= 0"])]


def test_store_violations(spark, table, tmp_path):
    quality.store_violations(table, {"v >= 0": F.col("v") >= 0}, str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_ranges(spark):
    fact = spark.createDataFrame(
        [(0.0, 1e7, 1.0), (1e6 + 1, 1e7 + 1, -1.0), (None, 1.0, 5e7)],
        "scope1_kgco2e double, scope2_market_based_kgco2e double, scope3_kgco2e double",
    )
    assert rows(quality.scope_ranges(fact), "out_of_range") == [(1,), (1,), (1,)]


def test_freshness(spark):
    fact = spark.createDataFrame(
        [("AWS", date(2024, 1, 1)), ("AWS", date(2024, 3, 1)), ("GCP", date(2024, 1, 1))],
        "cloud_provider string, usage_month_start date",
    )
    got = rows(quality.freshness(fact, F.lit(date(2024, 5, 30))), "cloud_provider", "age_days", "is_fresh")
    assert got == [("AWS", 90, True), ("GCP", 150, False)]


def test_schema_report(spark):
    required = {"full": ["a"], "empty": ["a"], "narrow": ["a", "b"], "absent": ["a"]}
    tables = {
        "full": spark.range(3).withColumnRenamed("id", "a"),
        "empty": spark.range(0).withColumnRenamed("id", "a"),
        "narrow": spark.range(1).withColumnRenamed("id", "a"),
        "absent": None,
    }
    got = rows(quality.schema_report(tables, required))
    assert got == [("empty", 0, "", "warning"), ("full", 3, "", "ok"), ("narrow", 1, "b", "error")]
    assert quality.missing_tables(tables, required) == ["absent"]


def test_contract_gate(spark):
    one = spark.range(1).withColumnRenamed("id", "a")
    assert quality.require_contract({"t": one, "u": one.limit(0)}, {"t": ["a"], "u": ["a"]}) == ["u: no rows"]
    with pytest.raises(ValueError, match="t: missing columns b; |u: table is missing"):
        quality.require_contract({"t": one}, {"t": ["a", "b"], "u": ["a"]})


def test_suite_counts_nulls_and_repeats_in_one_pass(spark):
    table = spark.createDataFrame([(1, None), (1, "x"), (None, "y"), (None, None), (2, "z")], "id long, at string")
    once = quality.suite({"t": table}, {"t": (["id", "at"], ["id"])})
    want = [("t", "not_null", "at", 2), ("t", "not_null", "id", 2), ("t", "unique", "id", 1)]
    assert sorted(map(tuple, once.collect())) == want
    assert once._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    empty = quality.suite({"t": table.limit(0)}, {"t": (["id"], ["id"])})
    assert sorted(map(tuple, empty.collect())) == [("t", "not_null", "id", 0), ("t", "unique", "id", 0)]
