"""Which months of the raw tables have changed since the marts were last stored.

A load notes the months of its rows before it touches a raw table, and a build strikes them out after its
marts are stored. A run that dies in between leaves months noted twice or built twice, never forgotten.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.operators.upsert import remove_folder
from cindergrid.schemas import RAW_PERIOD


@dataclass(frozen=True)
class Waiting:
    """Months by feed, and the notes they come from: a file per load, a row per month of its feed."""

    months: dict[str, list[date]]
    notes: list[str]

    def of(self, feeds: set[str]) -> list[date]:
        return sorted({m for feed in feeds for m in self.months.get(feed, [])})


def _folder(raw_folder: str) -> str:
    return f"{raw_folder}/changes"


def note(raw_folder: str, feed: str, rows: DataFrame) -> None:
    """Remember the months of raw rows that are about to be stored; the notes of all feeds are one table."""
    months = rows.select(F.lit(feed).alias("feed"), F.trunc(RAW_PERIOD, "month").alias("month")).distinct()
    months.coalesce(1).write.mode("append").parquet(_folder(raw_folder))


def waiting(spark: SparkSession, raw_folder: str) -> Waiting:
    try:
        noted = spark.read.schema("feed string, month date").parquet(_folder(raw_folder))
        rows = noted.select("*", F.col("_metadata.file_name").alias("note")).distinct().collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    months: dict[str, set[date]] = {}
    for row in rows:
        months.setdefault(row["feed"], set()).add(row["month"])
    return Waiting({feed: sorted(found) for feed, found in months.items()}, sorted({f"{_folder(raw_folder)}/{row['note']}" for row in rows}))


def strike_out(spark: SparkSession, done: Waiting) -> None:
    """Forget exactly the notes that a build has seen; what was noted meanwhile stays."""
    for path in done.notes:
        remove_folder(spark, path)
