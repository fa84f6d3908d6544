"""Stored intermediates of one run: written to the shared work folder, read back, and freed when their readers are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cindergrid.operators.upsert import remove_folder
from cindergrid.session import work_folder


class Scratch:
    """Every ``store`` writes a table at once; ``free`` removes all but the ones to keep, when nothing reads them any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.tables: list[tuple[DataFrame, str]] = []

    def store(self, rows: DataFrame, name: str) -> DataFrame:
        path = work_folder(self.spark, f"{self.label}-{name}")
        rows.write.parquet(path)
        table = self.spark.read.parquet(path)
        self.tables.append((table, path))
        return table

    def free(self, *keep: DataFrame) -> None:
        for table, path in self.tables:
            if not any(table is k for k in keep):
                remove_folder(self.spark, path)
        self.tables = [(table, path) for table, path in self.tables if any(table is k for k in keep)]
