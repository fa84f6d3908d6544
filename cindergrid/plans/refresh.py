"""One load run: landed files to raw tables, raw tables to marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cindergrid.operators.upsert import remove_folder, upsert_parquet
from cindergrid.plans import changes
from cindergrid.plans.warehouse import CLOUD_FEEDS, GRID_FEEDS, build_marts, dashboard_tables, open_marts
from cindergrid.schemas import NATURAL_KEYS, RAW_PERIOD
from cindergrid.sources import feeds, landing
from cindergrid.sources.cursors import LOAD_WINDOWS, initial_load, load_period
from cindergrid.streaming.upsert import run_upsert


def normalise(landed: DataFrame, feed: str, account: str | Column | None = None) -> DataFrame:
    """Landed records of any feed as raw rows with their partition.

    ``account`` is the account or subscription of the two feeds whose records do not name it.
    """
    if feed == "gcp":
        raw = feeds.normalise_gcp(landed)
    elif feed in ("aws", "azure"):
        to_raw = feeds.normalise_aws if feed == "aws" else feeds.normalise_azure
        raw = to_raw(landed, F.col("AccountId") if account is None else account)
    elif feed == "ccf":
        raw = feeds.normalise_ccf(landed)
    elif feed == "grid":
        raw = feeds.normalise_grid_history(landed)
    else:
        raw = feeds.normalise_moer(landed)
    return raw.withColumn(RAW_PERIOD, load_period(feed))


def _record_shape(feed: str) -> str:
    return "tonnes" if feed in ("aws", "azure") else feed


def keyed(rows: DataFrame, feed: str) -> Column:
    """Whether a raw row can be stored: every part of its key, and so its time, is there."""
    known = F.lit(True)
    for name in (*NATURAL_KEYS[feed], LOAD_WINDOWS[feed].cursor):
        known = known & F.col(name).isNotNull()
    return known


def set_aside(spark: SparkSession, rejected: DataFrame, path: str) -> None:
    """Append rejected text to the quarantine; what is there already is not repeated."""
    text = rejected.select(F.col(rejected.columns[0]).alias("value")).distinct()
    try:
        text = text.join(spark.read.text(path), "value", "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    text.write.mode("append").text(path)


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*")).alias("value"))


FILES = "path string, length long, modified timestamp"
#: Files that a load reads and notes at a time, about; their names are all that the driver holds.
FILES_AT_A_TIME = 10_000


def _not_loaded(spark: SparkSession, listed: DataFrame, path: str) -> DataFrame:
    """Listed files that no finished load has read as they are now."""
    try:
        return listed.join(spark.read.schema(FILES).parquet(path), ["path", "length", "modified"], "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return listed


def load_feed(
    spark: SparkSession,
    feed: str,
    paths: str | Sequence[str],
    raw_folder: str,
    as_of: Column | None = None,
    account: str | Column | None = None,
    quarantine: str | None = None,
    landed_after: datetime | None = None,
    lookback: int | None = None,
    every_file: bool = False,
    files_at_a_time: int = FILES_AT_A_TIME,
) -> DataFrame:
    """Load what a feed has landed since the last run; returns the raw table.

    New data is told by its files, not by its event times: all rows of files that no finished load
    has read are upserted, however late or corrected they are, and the version settles
    restatements. Files are known by path, length and modification time, listed in
    ``<raw_folder>/files/<feed>``, so one that appears with an old time is new and one that changed is
    read again. ``every_file`` reads the whole archive, ``landed_after`` (UTC) the files since then. Only with
    an explicit ``lookback`` (in the feed's unit, before ``as_of``) are older rows left out.

    A large archive is taken in lots of about ``files_at_a_time`` files, each noted when it is stored: the driver
    holds the names of one lot, and a load that dies goes on with the lot it was at.

    Lines that are no records, and rows without a key or time, go to the quarantine, by
    default ``<raw_folder>/quarantine/<feed>``. The months of all other rows are noted for the marts.
    """
    done = f"{raw_folder}/files/{feed}"
    listed = landing.list_files(spark, paths, landed_after).distinct()
    todo = listed if every_file or landed_after else _not_loaded(spark, listed, done)
    # Listed once: what is read and what is noted are the same files, whatever lands meanwhile.
    staged = f"{raw_folder}/staging/{feed}-files"
    todo.write.mode("overwrite").parquet(staged)
    todo = spark.read.schema(FILES).parquet(staged)
    lots = max(1, -(-todo.count() // files_at_a_time))
    for lot in range(lots):
        files = todo.where(F.pmod(F.xxhash64("path"), F.lit(lots)) == lot).collect()
        table = _load_files(spark, feed, files, raw_folder, as_of, account, quarantine, lookback)
        # Written last: a lot that dies is done again from the same files.
        spark.createDataFrame(files, FILES).coalesce(1).write.mode("append").parquet(done)
    remove_folder(spark, staged)
    return table


def _load_files(spark: SparkSession, feed: str, files, raw_folder: str, as_of, account, quarantine, lookback) -> DataFrame:
    """Parses the files once, sets bad records aside and upserts the rest."""
    parsed = f"{raw_folder}/staging/{feed}-parsed"
    landing.read_files(spark, _record_shape(feed), [f["path"] for f in files]).write.mode("overwrite").parquet(parsed)
    landed = landing.parsed_landing(spark, _record_shape(feed), parsed)
    rows = normalise(landing.good_records(landed), feed, account)
    aside = f"{quarantine or raw_folder + '/quarantine'}/{feed}"
    set_aside(spark, landing.bad_records(landed).unionAll(_as_text(rows.where(~keyed(rows, feed)))), aside)
    arriving = rows.where(keyed(rows, feed))
    if lookback is not None:
        arriving = initial_load(arriving, feed, F.current_timestamp() if as_of is None else as_of, lookback)
    table = _upsert(spark, feed, arriving, raw_folder)
    remove_folder(spark, parsed)
    return table


def _upsert(spark: SparkSession, feed: str, arriving: DataFrame, raw_folder: str) -> DataFrame:
    """Into the raw table; the months it changes are noted before it changes."""
    path = f"{raw_folder}/{feed}"
    upsert_parquet(
        spark, path, arriving, NATURAL_KEYS[feed], [RAW_PERIOD], staging=f"{raw_folder}/staging/{feed}",
        before=lambda staged: changes.note(raw_folder, feed, staged),
    )
    return spark.read.schema(arriving.schema).parquet(path)


def load_export(
    spark: SparkSession, paths: str | Sequence[str], raw_folder: str, min_month: date | None = None
) -> DataFrame:
    """Upsert the nested feed from its typed table export; returns the raw table."""
    rows = normalise(landing.read_export(spark, paths, min_month), "gcp")
    set_aside(spark, _as_text(rows.where(~keyed(rows, "gcp"))), f"{raw_folder}/quarantine/gcp")
    return _upsert(spark, "gcp", rows.where(keyed(rows, "gcp")), raw_folder)


def follow_feed(
    spark: SparkSession,
    feed: str,
    path: str,
    raw_folder: str,
    checkpoint: str,
    account: str | Column | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """The same load as a stream over the landing folder: the checkpoint is the cursor."""
    aside = f"{quarantine or raw_folder + '/quarantine'}/{feed}"
    landed = landing.stream_landing(spark, _record_shape(feed), path)

    def accept(batch: DataFrame) -> DataFrame:
        rows = normalise(landing.good_records(batch), feed, account)
        set_aside(spark, landing.bad_records(batch).unionAll(_as_text(rows.where(~keyed(rows, feed)))), aside)
        return rows.where(keyed(rows, feed))

    return run_upsert(
        landed, f"{raw_folder}/{feed}", checkpoint, NATURAL_KEYS[feed], [RAW_PERIOD], accept=accept,
        before=lambda staged: changes.note(raw_folder, feed, staged),
    )


def stored_raw(spark: SparkSession, raw_folder: str) -> dict[str, DataFrame]:
    """The raw tables loaded so far; feeds without any data are left out."""
    tables = {}
    for feed in LOAD_WINDOWS:
        try:
            tables[feed] = spark.read.parquet(f"{raw_folder}/{feed}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return tables


def refresh(
    spark: SparkSession,
    landed: Mapping[str, str | Sequence[str]],
    raw_folder: str,
    mart_folder: str,
    as_of: Column | None = None,
    landed_after: datetime | None = None,
    since: date | None = None,
    quarantine: str | None = None,
    lookback: Mapping[str, int] | None = None,
    touched_only: bool = False,
) -> dict[str, DataFrame]:
    """Load the given feeds, then build the marts from every feed loaded so far.

    All months are built, or those from ``since`` on, or with ``touched_only`` those that have changed since the
    marts were last stored: by this load, by loads of other runs and by runs that died before their marts. A
    month that has no rows any more leaves the marts, and marts without changes are returned as they are
    stored. ``lookback`` names feeds whose older rows are left out.
    The daily mart comes back in the dashboards' names, so that the result meets their contract.
    """
    for feed, paths in landed.items():
        load_feed(
            spark, feed, paths, raw_folder, as_of, None, quarantine, landed_after, (lookback or {}).get(feed)
        )
    return dashboard_tables(follow_changes(spark, raw_folder, mart_folder, since, touched_only))


def follow_changes(
    spark: SparkSession, raw_folder: str, mart_folder: str, since: date | None = None, touched_only: bool = True
) -> dict[str, DataFrame]:
    """Bring the marts up to the raw tables; what has been noted until now is struck out when they are stored."""
    if since and touched_only:
        raise ValueError("either the touched months or all since one, not both")
    raw, noted = stored_raw(spark, raw_folder), changes.waiting(spark, raw_folder)
    if not touched_only:
        marts = build_marts(spark, raw, mart_folder, since)
        if since is None or min([since.replace(day=1), *noted.of(set(LOAD_WINDOWS))]) >= since.replace(day=1):
            changes.strike_out(spark, noted)
        return marts
    sides = {"cloud": CLOUD_FEEDS, "grid": GRID_FEEDS}
    stored = open_marts(spark, mart_folder)
    marts = {}
    for side, fact in (("cloud", "fact_cloud_carbon"), ("grid", "fact_grid_intensity")):
        of_side = {feed: rows for feed, rows in raw.items() if feed in sides[side]}
        if of_side and fact not in stored:  # never built, so no notes can be complete
            marts |= build_marts(spark, of_side, mart_folder)
        elif found := noted.of(sides[side]):
            marts |= build_marts(spark, of_side, mart_folder, months={side: found})
    changes.strike_out(spark, noted)
    return open_marts(spark, mart_folder, stored.keys() - marts.keys()) | marts
