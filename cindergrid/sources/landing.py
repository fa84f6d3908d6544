"""Reading landed JSON with an explicit schema, bad records set aside instead of failing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.schemas import CORRUPT, LANDED
from cindergrid.session import require_utc


def read_landing(
    spark: SparkSession,
    feed: str,
    paths: str | Sequence[str],
    landed_after: datetime | None = None,
) -> DataFrame:
    """All files of all keys in one scan, one JSON object per line.

    One path or pattern per zone or authority replaces a request loop, and a bad line of one
    key does not stop the others: it keeps its text in ``_corrupt_record``. The lines are
    read as text and parsed, because the JSON reader refuses to return that column alone.
    ``landed_after`` (UTC) leaves out files that have not changed since, so a load run reads
    what is new and not the whole archive.
    """
    reader = spark.read
    if landed_after:
        reader = reader.option("modifiedAfter", landed_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return parse_landing(_filled(reader.text(paths)), feed)


def list_files(spark: SparkSession, paths: str | Sequence[str], landed_after: datetime | None = None) -> DataFrame:
    """``path, length, modified`` of the landed files, from the listing alone: no content is read."""
    reader = spark.read.format("binaryFile")
    if landed_after:
        reader = reader.option("modifiedAfter", landed_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return reader.load(paths).select("path", "length", F.col("modificationTime").alias("modified"))


def read_files(spark: SparkSession, feed: str, files: Sequence[str]) -> DataFrame:
    """Records of exactly these files, whatever characters their names have."""
    if not files:
        return parse_landing(spark.createDataFrame([], "value string"), feed)
    return parse_landing(_filled(spark.read.text([re.sub(r"([\\*?\[\]{}])", r"\\\1", f) for f in files])), feed)


def parsed_landing(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Parsed records, stored as :func:`read_files` returned them."""
    return spark.read.schema(f"{LANDED[feed]}, {CORRUPT} string").parquet(path)


def read_export(spark: SparkSession, paths: str | Sequence[str], min_month: date | None = None) -> DataFrame:
    """The typed table export of the nested feed, from ``min_month`` on; the bound reaches the scan."""
    rows = spark.read.schema(LANDED["gcp"]).parquet(*([paths] if isinstance(paths, str) else paths))
    return rows if min_month is None else rows.where(F.col("usage_month") >= F.lit(min_month))


def stream_landing(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """The same records as a stream; the query's checkpoint is the load cursor."""
    return parse_landing(_filled(spark.readStream.text(path)), feed)


def _filled(lines: DataFrame) -> DataFrame:
    """Blank lines are no records."""
    return lines.where(F.trim("value") != "")


def parse_landing(lines: DataFrame, feed: str, text: Column | str = "value") -> DataFrame:
    """Records from a text column."""
    require_utc(lines.sparkSession)
    text = F.col(text) if isinstance(text, str) else text
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(text, f"{LANDED[feed]}, {CORRUPT} string", options)
    # As a generator, not a projection: a later filter on the corrupt column would otherwise
    # be moved below it together with a second copy of the parser.
    return lines.select(F.inline(F.array(record)))


def good_records(landed: DataFrame) -> DataFrame:
    return landed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_records(landed: DataFrame) -> DataFrame:
    """The rejected text, to be written next to the raw table."""
    return landed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
