"""Hourly rollup of the five-minute marginal rates as a stream that takes late points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cindergrid.functions.measures import GRAMS_PER_KG
from cindergrid.functions.time import start_of
from cindergrid.operators.staging import MARGINAL_SOURCE, stage_moer
from cindergrid.operators.upsert import touched_partitions, upsert_parquet

POINT_KEYS = ["ba", "point_time"]
HOUR_KEYS = ["grid_region", "timestamp_hour"]
DAY = "day"
# Stated, as a table whose last hour was corrected away has no file to read it from.
HOURS = (
    "grid_region string, timestamp_hour timestamp_ntz, data_source string, carbon_intensity_kgco2eq_per_kwh double, "
    "carbon_intensity_gco2eq_per_kwh double, percentile_rank double, sum_kgco2_per_kwh double, points bigint, "
    "extracted_at timestamp_ntz, day date"
)


def hourly_points(raw: DataFrame) -> DataFrame:
    """Raw marginal rates to hours, with the sums and counts behind the averages."""
    rate = F.col("moer_kgco2_per_kwh")
    return (
        stage_moer(raw)
        .groupBy("ba", start_of("hour", F.col("point_time")).alias("timestamp_hour"))
        .agg(
            F.avg(rate).alias("carbon_intensity_kgco2eq_per_kwh"),
            F.avg(rate * GRAMS_PER_KG).alias("carbon_intensity_gco2eq_per_kwh"),
            F.avg("percent").alias("percentile_rank"),
            F.sum(rate).alias("sum_kgco2_per_kwh"),
            F.count(rate).alias("points"),
            F.max("extracted_at").alias("extracted_at"),
        )
        .select(
            F.col("ba").alias("grid_region"),
            "timestamp_hour",
            F.lit(MARGINAL_SOURCE).alias("data_source"),
            "carbon_intensity_kgco2eq_per_kwh",
            "carbon_intensity_gco2eq_per_kwh",
            "percentile_rank",
            "sum_kgco2_per_kwh",
            "points",
            "extracted_at",
        )
    )


def run_hourly(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is available, upsert points and hours, stop.

    Each micro-batch is merged into ``<path>/points`` by authority and time; the hours that it
    touches are computed anew from the stored points and take the place of what ``<path>/hours`` has of them.
    So every hour is there as soon as it has a point that counts and goes when its last one is corrected
    away, a late or corrected point changes its hour however late it is, and a replayed batch changes nothing.
    Days partition both tables: a batch reads and rewrites the days it has points of.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        points = batch.withColumn(DAY, F.to_date("point_time"))
        upsert_parquet(
            spark, f"{path}/points", points, POINT_KEYS, [DAY], staging=f"{checkpoint}-staging/points"
        )
        stored = spark.read.schema(points.schema).parquet(f"{path}/points")
        hour = start_of("hour", F.col("point_time")).alias("hour")
        touched = points.select("ba", hour, DAY).distinct()
        same_days = touched_partitions(stored, touched, [DAY]).withColumn("hour", hour)
        # Null-safe: points without an authority have their hours too.
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("ba", "hour", DAY)]
        of_hours = same_days.alias("l").join(touched.alias("r"), same, "left_semi").select(*points.columns)
        upsert_parquet(
            spark, f"{path}/hours", hourly_points(of_hours).withColumn(DAY, F.to_date("timestamp_hour")), HOUR_KEYS, [DAY],
            staging=f"{checkpoint}-staging/hours",
            removed=touched.select(F.col("ba").alias("grid_region"), F.col("hour").alias("timestamp_hour"), DAY),
        )

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_hours(spark, path: str) -> DataFrame:
    return spark.read.schema(HOURS).parquet(f"{path}/hours").drop(DAY)
