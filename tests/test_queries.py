from datetime import date, datetime, timezone

import pytest
from conftest import plan, ts
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from cindergrid.operators import emissions, grid
from cindergrid.plans import api, dashboards
from cindergrid.plans.testbed_queries import cloud_fact, grid_fact


@pytest.fixture(scope="module")
def cloud(spark, sf):
    return cloud_fact(spark, sf).cache()


@pytest.fixture(scope="module")
def readings(spark, sf):
    return grid_fact(spark, sf).cache()


def test_cloud_filters(cloud):
    got = api.cloud_emissions(
        cloud, provider="AWS", start_month=date(1996, 1, 1), end_month=date(1997, 1, 1),
        service_name="mall", region="NATION_3", limit=10000,
    ).collect()
    assert got and {r.cloud_provider for r in got} == {"AWS"}
    assert {r.service_name for r in got} == {"SMALL"} and {r.region for r in got} == {"NATION_3"}
    assert min(r.usage_month_start for r in got) >= date(1996, 1, 1)
    assert max(r.usage_month_start for r in got) <= date(1997, 1, 1)
    account = got[0].account_id
    assert {r.account_id for r in api.cloud_emissions(cloud, account_id=account).collect()} == {account}


def test_top_k_is_not_a_global_sort(cloud):
    text = plan(api.cloud_emissions(cloud))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_ties_and_nulls_in_top_k(spark):
    fact = spark.createDataFrame(
        [("b", date(2024, 1, 1), 5.0), ("a", date(2024, 1, 1), 5.0), ("c", date(2024, 1, 1), None),
         ("d", None, 9.0)],
        "id string, usage_month_start date, total_kgco2e double",
    )
    for name in (
        "cloud_provider", "account_id", "service_name", "region", "scope1_kgco2e",
        "scope2_market_based_kgco2e", "scope3_kgco2e", "total_mtco2e", "kgco2e_per_dollar",
        "kgco2e_per_kwh", "extracted_at",
    ):
        fact = fact.withColumn(name, F.lit(None).cast("string"))
    assert [r.id for r in api.cloud_emissions(fact, limit=3).collect()] == ["a", "b", "c"]


@pytest.mark.parametrize("limit", [0, -1])
def test_limits_are_checked(cloud, limit):
    with pytest.raises(ValueError):
        api.cloud_emissions(cloud, limit=limit)


def test_choices_are_checked(cloud, readings):
    with pytest.raises(ValueError):
        api.cloud_emissions(cloud, provider="Oracle")
    with pytest.raises(ValueError):
        api.grid_intensity(readings, source="elsewhere")
    assert api.cloud_summary(cloud, provider="all").count() == 3


def test_grid_filters(readings):
    got = api.grid_intensity(
        readings, region="us-", source="WattTime", start_time=datetime(2024, 1, 10),
        end_time=datetime(2024, 1, 12, tzinfo=timezone.utc), limit=10000,
    ).collect()
    assert got and {r.grid_region for r in got} == {"US-TEX-ERCO"}
    assert {r.data_source for r in got} == {"WattTime"}
    assert all(ts("2024-01-10") <= r.timestamp_hour <= ts("2024-01-12") for r in got)


def test_current_keeps_ties(spark):
    columns = (
        "grid_region string, timestamp_hour timestamp_ntz, carbon_intensity_gco2eq_per_kwh double, "
        "intensity_category string, fossil_fuel_percentage double, renewable_percentage double, "
        "data_source string"
    )
    fact = spark.createDataFrame(
        [
            ("DE", ts("2024-01-01 01:00"), 10.0, "x", None, None, "a"),
            ("DE", ts("2024-01-01 02:00"), 20.0, "x", None, None, "a"),
            ("DE", ts("2024-01-01 02:00"), 30.0, "x", None, None, "b"),
            ("FR", ts("2024-01-01 01:00"), 25.0, "x", None, None, "a"),
        ],
        columns,
    )
    got = [(r.grid_region, r.data_source) for r in api.current_grid_intensity(fact).collect()]
    assert got == [("DE", "b"), ("FR", "a"), ("DE", "a")]
    assert api.current_grid_intensity(fact, "de").count() == 2


def test_ad_hoc_reads_only(spark, readings):
    api.register_views({"fact_grid_intensity": readings})
    query = "SELECT count(*) AS created_at FROM fact_grid_intensity -- note"
    assert api.ad_hoc(spark, query).first().created_at == readings.count()
    assert api.ad_hoc(spark, "WITH a AS (SELECT 1 AS x) SELECT x FROM a;").first().x == 1
    nested = "SELECT * FROM (SELECT grid_region FROM fact_grid_intensity WHERE timestamp_hour = (SELECT max(timestamp_hour) FROM fact_grid_intensity)) a"
    assert api.ad_hoc(spark, nested).count() > 0
    spark.range(3).createOrReplaceTempView("private_numbers")
    for text in (
        "DROP VIEW fact_grid_intensity",
        "CREATE TABLE t AS SELECT 1",
        "INSERT INTO fact_grid_intensity VALUES (1)",
        "WITH a AS (SELECT 1 AS x) INSERT INTO fact_grid_intensity SELECT * FROM a",
        "SET spark.sql.ansi.enabled=false",
        "SELECT 1) AS a; DROP VIEW fact_grid_intensity; SELECT (1",
        "SELECT 1 AS a) AS z CROSS JOIN (SELECT 2 AS b",
        "SELECT * FROM text.`/etc/hostname`",
        "SELECT (SELECT max(value) FROM text.`/etc/hostname`) AS v",
        "SELECT * FROM private_numbers",
        "SELECT * FROM fact_grid_intensity WHERE EXISTS (SELECT 1 FROM private_numbers)",
        "SELECT java_method('java.lang.System', 'setProperty', 'a', 'b')",
        "SELECT grid_region FROM fact_grid_intensity WHERE reflect('java.lang.System', 'getProperty', 'user.home') = 'x'",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
    ):
        with pytest.raises((ParseException, AnalysisException, PermissionError)):
            api.ad_hoc(spark, text)
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"
    assert spark.catalog.tableExists("fact_grid_intensity")


@pytest.fixture
def open_view(spark):
    rows_in = spark.createDataFrame([(1, "a", [1, 2]), (2, "b", [3])], "id int, name string, list array<int>")
    api.register_views({"v": rows_in})
    spark.range(3).createOrReplaceTempView("private_numbers")
    return rows_in


def test_ad_hoc_takes_ordinary_queries(spark, open_view):
    for text, n in {
        "SELECT * FROM v": 2,
        "SELECT name, count(*) AS n, max(id) FILTER (WHERE id > 0) AS m FROM v GROUP BY ALL ORDER BY ALL LIMIT 5 OFFSET 0": 2,
        "SELECT DISTINCT a.name FROM v a JOIN v b ON a.id = b.id AND a.name <= b.name": 2,
        "SELECT x FROM v LATERAL VIEW explode(list) t AS x WHERE x IN (SELECT id FROM v)": 2,
        "WITH w(i) AS (SELECT id FROM v), z AS (SELECT i FROM w) SELECT i FROM z UNION ALL SELECT i FROM w": 4,
        "SELECT id, sum(id) OVER (PARTITION BY name ORDER BY id ROWS UNBOUNDED PRECEDING) AS s FROM v": 2,
        "SELECT * FROM (VALUES (1, 'x')) AS t(i, n) WHERE EXISTS (SELECT 1 FROM v WHERE v.id = t.i)": 1,
        "SELECT CASE WHEN name LIKE 'a%' THEN upper(name) ELSE date_format(DATE '2024-01-02', 'yyyy') END AS c FROM v": 2,
        "SELECT id, share FROM v, (SELECT avg(id) AS share FROM v) m": 2,
        "SELECT name, transform(list, x -> x + 1) AS t FROM v EXCEPT SELECT name, list FROM v": 2,
        "SELECT name FROM v GROUP BY name HAVING count(*) > 0": 2,
        "SELECT * FROM (SELECT name, id FROM v) PIVOT (sum(id) FOR name IN ('a', 'b'))": 1,
    }.items():
        assert api.ad_hoc(spark, text).count() == n, text


def test_ad_hoc_refuses_and_leaves_no_trace(spark, open_view, tmp_path):
    out = tmp_path / "out"
    before = {r.name for r in spark.catalog.listTables()}
    spark.udf.register("plus", lambda x: x, "int")
    for text in (
        "SELECT transform(id) USING 'id -un' AS (who string) FROM v",
        f"SELECT transform(id) USING 'touch {out}' AS (who string) FROM v",
        f"INSERT OVERWRITE DIRECTORY '{out}' USING csv SELECT 1",
        f"INSERT OVERWRITE LOCAL DIRECTORY '{out}' SELECT id FROM v",
        f"FROM v INSERT OVERWRITE DIRECTORY '{out}' USING csv SELECT id",
        f"CREATE TABLE t USING csv LOCATION '{out}' AS SELECT 1 AS a",
        "EXECUTE IMMEDIATE 'DROP VIEW v'",
        "EXECUTE IMMEDIATE 'SET spark.cindergrid.x=y'",
        "BEGIN DROP VIEW v; END",
        "DECLARE x INT DEFAULT 1",
        "SET VAR x = 1",
        "SET spark.cindergrid.x=y",
        "CACHE TABLE private_numbers",
        "ADD JAR '/tmp/x.jar'",
        "USE default",
        "EXPLAIN SELECT * FROM private_numbers",
        "DESCRIBE private_numbers",
        "SHOW TABLES",
        "TRUNCATE TABLE v",
        "SELECT java_method('java.lang.System', 'setProperty', 'cindergrid', 'b')",
        "SELECT * FROM v WHERE id = (SELECT reflect('java.lang.System', 'setProperty', 'cindergrid', 'b'))",
        "SELECT * FROM v ORDER BY try_reflect('java.lang.System', 'setProperty', 'cindergrid', 'b')",
        "WITH w AS (SELECT java_method('java.lang.System', 'setProperty', 'cindergrid', 'b') AS p) SELECT p FROM w",
        "SELECT x FROM v LATERAL VIEW explode(array(reflect('java.lang.System', 'setProperty', 'cindergrid', 'b'))) t AS x",
        "SELECT plus(id) FROM v",
        "SELECT session.plus(id) FROM v",
        "SELECT input_file_name() FROM v",
        "SELECT raise_error('x') FROM v",
        "SELECT * FROM range(1000000000)",
        "SELECT * FROM IDENTIFIER('private_numbers')",
        "SELECT * FROM private_numbers",
        "SELECT * FROM default.v",
        "SELECT * FROM csv.`/etc/passwd`",
        "SELECT * FROM v VERSION AS OF 1",
        "SELECT (SELECT max(id) FROM private_numbers) AS m FROM v",
        "SELECT * FROM v WHERE id IN (SELECT id FROM private_numbers)",
        "WITH w AS (SELECT * FROM private_numbers) SELECT * FROM w",
        "WITH private_numbers AS (SELECT * FROM private_numbers) SELECT * FROM private_numbers",
        "SELECT a.id FROM v a CROSS JOIN v b",
        "SELECT a.id FROM v a, v b",
        "SELECT a.id FROM v a JOIN v b ON a.id < b.id",
        "SELECT id FROM v a WHERE EXISTS (SELECT 1 FROM v b WHERE b.id < a.id)",
        "SELECT a.id FROM v a LEFT JOIN LATERAL (SELECT b.id FROM v b) ON true",
    ):
        with pytest.raises((PermissionError, ParseException, AnalysisException)):
            api.ad_hoc(spark, text).collect()
            pytest.fail(text)
    assert not out.exists()
    assert {r.name for r in spark.catalog.listTables()} == before
    assert spark.conf.get("spark.cindergrid.x", None) is None
    assert spark._jvm.java.lang.System.getProperty("cindergrid") is None


def test_ad_hoc_refuses_large_scans(spark, sf):
    api.register_views({"lines": spark.read.parquet(f"{sf}/lineitem.parquet")})
    assert api.ad_hoc(spark, "SELECT count(*) AS n FROM lines").first().n > 0
    with pytest.raises(PermissionError, match="bytes"):
        api.ad_hoc(spark, "SELECT count(*) AS n FROM lines", most_bytes=1000)


def test_a_function_that_stands_in_for_a_built_in_is_refused(spark):
    other = spark.newSession()
    api.register_views({"v": other.createDataFrame([(1, "a")], "id int, name string")})
    assert api.ad_hoc(other, "SELECT initcap(name) AS n FROM v").first().n == "A"
    other.udf.register("initcap", lambda x: "not it", "string")
    with pytest.raises(PermissionError):
        api.ad_hoc(other, "SELECT initcap(name) FROM v")


def test_records(cloud):
    answer = api.records(cloud.orderBy("id"), limit=5)
    assert answer["count"] == 5 and answer["data"][0]["cloud_provider"]


def test_trend_limit(cloud):
    trends = emissions.carbon_trends(cloud, ordered=False)
    assert api.trend_rows(trends).count() == 12
    assert api.trend_rows(trends, limit=None).count() == trends.count()
    with pytest.raises(ValueError):
        api.trend_rows(trends, limit=0)


def test_rows_as_text(spark):
    rows_in = spark.createDataFrame([(1, 'a "quoted", x'), (2, None)], "n int, t string")
    assert [r.value for r in api.as_text(rows_in).collect()] == ['{"n":1,"t":"a \\"quoted\\", x"}', '{"n":2,"t":null}']
    assert api.as_text(rows_in, "csv").first().value == '1,"a ""quoted"", x"'
    with pytest.raises(ValueError):
        api.as_text(rows_in, "xml")


def test_latest_reading_in_one_pass(spark, sf):
    from cindergrid.plans.testbed_queries import QUERIES

    assert plan(QUERIES["q_grid_current"](spark, sf)).count("events.parquet]") == 2


def test_scope_breakdown_scans_once(cloud):
    got = {r.scope: r.mtco2e for r in dashboards.scope_breakdown(cloud).collect()}
    assert list(got) == ["Scope 1", "Scope 2 (Market-Based)", "Scope 3"]
    assert got["Scope 1"] == pytest.approx(cloud.agg(F.sum("scope1_kgco2e")).first()[0] / 1000)
    assert plan(dashboards.scope_breakdown(cloud)).count("InMemoryTableScan (") <= 1


def test_recent_windows(readings):
    last = readings.agg(F.max("timestamp_hour")).first()[0]
    day = dashboards.current_intensity(readings).collect()
    assert min((last - r.timestamp_hour).total_seconds() for r in day) == 0
    assert max((last - r.timestamp_hour).total_seconds() for r in day) <= 86400
    week = dashboards.intensity_trend(readings).count()
    assert dashboards.by_category(readings).agg(F.sum("count")).first()[0] == week


def test_last_week_takes_a_clock(spark, sf, readings):
    from cindergrid.sources import testbed

    daily = grid.daily_for_dashboards(grid.grid_intensity_daily(readings))
    dim = testbed.region_dim(spark, sf)
    got = dashboards.daily_averages(daily, dim, date(2024, 1, 20)).agg(F.min("date")).first()[0]
    assert got == date(2024, 1, 13)
    assert dashboards.daily_averages(daily, dim).count() == 0  # today is long after the data
    top = dashboards.weekly_comparison(daily, dim, date(2024, 1, 20)).collect()
    assert [r.avg_intensity for r in top] == sorted(r.avg_intensity for r in top)
    assert "city" in dim.columns


def test_cleanest_puts_unread_grids_last(spark):
    with_grid = spark.createDataFrame(
        [("GCP", f"r{i}", f"g{i}", f"n{i}", "c", None if i < 3 else float(i), "x", 1.0, 0.0, 0.0)
         for i in range(12)],
        "cloud_provider string, datacenter_region string, grid_region string, grid_region_name string, "
        "country string, grid_avg_intensity double, cleanliness_category string, "
        "total_emissions_mtco2e double, latitude double, longitude double",
    )
    got = [r.grid_avg_intensity for r in dashboards.cleanest_datacenters(with_grid).collect()]
    assert got == [float(i) for i in range(3, 12)] + [None]


def test_no_cross_joins_and_no_python(spark, sf):
    from cindergrid.plans.testbed_queries import QUERIES

    started = {
        "stream_hourly", "stream_upsert", "stream_corrected", "load_late", "refresh_touched", "export_parquet", "export_csv", "export_csv_limited",
        "export_csv_dump",
    }
    for name, query in QUERIES.items():
        if name in started:
            continue
        text = plan(query(spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "InPandas" not in text, name


