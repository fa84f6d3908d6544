"""Merge of arriving rows into a table by natural key, in memory and on plain Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindergrid.session import work_folder


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe, so a replayed row with a NULL key part still replaces itself."""
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    return left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, same), how)


def latest_per_key(batch: DataFrame, keys: Sequence[str], version: str = "extracted_at") -> DataFrame:
    """One row per key: the highest version, ties settled by the remaining columns.

    An aggregate rather than a ranked window: copies of one key collapse in the map tasks,
    so a key with a third of the batch does not end up in a single sort. The tie rule makes
    a retried task return the same row. Each row travels once, its maps as text, since maps
    have no order.
    """
    others = [f for f in batch.schema.fields if f.name not in (*keys, version)]
    maps = {f.name: f.dataType for f in others if isinstance(f.dataType, T.MapType)}
    shown = [F.to_json(f.name).alias(f.name) if f.name in maps else F.col(f.name) for f in others]
    newest = batch.groupBy(*keys).agg(F.max(F.struct(F.col(version), *shown)).alias("row"))
    rest = [
        F.from_json(F.col("row")[f.name], maps[f.name]).alias(f.name) if f.name in maps else F.col("row")[f.name].alias(f.name)
        for f in others
    ]
    return newest.select(*keys, F.col("row")[version].alias(version), *rest)


def replace_rows(target: DataFrame, arriving: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key does not arrive, plus the arriving rows; those hold each key once.

    The left-anti join shuffles on the key, or broadcasts the arriving side if Spark measures
    it below its threshold.
    """
    kept = _join_on(target, arriving, keys, "left_anti")
    return kept.unionByName(arriving.select(*target.columns))


def merge_upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str = "extracted_at"
) -> DataFrame:
    """The target with the newest arriving row of every key in the batch."""
    return replace_rows(target, latest_per_key(batch, keys, version), keys)


def write_partitioned(
    rows: DataFrame, path: str, partition_by: Sequence[str], replace_all: bool = False
) -> None:
    """Replace the partitions that occur in ``rows``, or with ``replace_all`` the whole table.

    Rebalancing by the partition columns keeps the number of files low. Unlike a plain
    repartition it lets Spark split a partition that holds a third of the data over several
    tasks instead of one.
    """
    (
        rows.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def upsert_parquet(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    version: str = "extracted_at",
    staging: str | None = None,
    removed: DataFrame | None = None,
    before: Callable[[DataFrame], None] | None = None,
) -> None:
    """Upsert into a partitioned Parquet table, touching only the batch's partitions.

    1. The newest row per key goes to a staging folder, so the batch is evaluated once.
    2. Target partitions between the lowest and the highest arriving one are read (the rest
       is pruned at run time), cut to those that really occur, and merged into the staging
       folder: Spark cannot overwrite what it reads. Then the folder is marked ready.
    3. The merged partitions replace the old ones, those that come out empty go; the mark is taken away.

    ``removed`` names keys (with their partition columns) whose rows go unless the batch has them again.
    ``before`` is called with the staged batch before the table changes in any way, so what it
    notes is known even if the run dies in the middle.

    A run that died before the mark has not touched the table. One that died after it may have
    replaced, or only removed, some partitions; the staging folder then has the only whole copy.
    So the first thing a run on the same ``staging`` does is to complete the one before it, and
    the folder goes once the mark is taken away.
    ``partition_by`` columns must be part of the key or derived from it: then a key never
    changes its partition.
    """
    staging = staging or work_folder(spark, "upsert")
    finish_pending(spark, path, staging, batch.schema, partition_by)
    target = open_or_create(spark, path, batch, partition_by)
    newest = latest_per_key(batch, keys, version).select(*batch.columns)
    write_partitioned(newest, f"{staging}/arriving", partition_by, replace_all=True)
    arriving = spark.read.schema(batch.schema).parquet(f"{staging}/arriving").select(*batch.columns)
    if before:
        before(arriving)

    named = [*dict.fromkeys([*keys, *partition_by])]
    gone = arriving.select(*named)
    if removed is not None:
        gone = gone.unionByName(removed.select(*named))
    touched = gone.select(*partition_by).distinct()
    kept = _join_on(touched_partitions(target, gone, partition_by), gone, keys, "left_anti")
    stage_replacement(kept.unionByName(arriving.select(*target.columns)), staging, partition_by, touched)
    move_in(spark, path, staging, batch.schema, partition_by)


def stage_replacement(
    rows: DataFrame, staging: str, partition_by: Sequence[str], touched: DataFrame | None
) -> None:
    """Write what shall stand in the ``touched`` partitions (all, if None) beside the table, then mark it ready.

    Touched partitions are stored as empty-handed folders of the same names, so those without rows are known.
    """
    spark = rows.sparkSession
    if partition_by:
        write_partitioned(rows, f"{staging}/merged", partition_by, replace_all=True)
    else:
        rows.write.mode("overwrite").parquet(f"{staging}/merged")
    if touched is not None:
        names = touched.select(*partition_by, F.lit(True).alias("touched")).coalesce(1)
        names.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{staging}/touched")
    else:
        remove_folder(spark, f"{staging}/touched")
    _mark(spark, staging, ready=True)


def move_in(
    spark: SparkSession, path: str, staging: str, schema: T.StructType, partition_by: Sequence[str]
) -> None:
    """Put the staged rows in place; they are complete, so doing it twice is harmless.

    They are written anew rather than renamed, because a rename is no single step on every storage.
    """
    merged = spark.read.schema(schema).parquet(f"{staging}/merged")
    partial = has_folder(spark, f"{staging}/touched")
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partial else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    if partial:
        left = _folders(spark, f"{staging}/merged", len(partition_by))
        for name in _folders(spark, f"{staging}/touched", len(partition_by)) - left:
            remove_folder(spark, f"{path}/{name}")
    _mark(spark, staging, ready=False)
    remove_folder(spark, staging)


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system, whatever the storage is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _path(spark, path)
    files.delete(folder, True)


def has_folder(spark: SparkSession, path: str) -> bool:
    folder, files = _path(spark, path)
    return files.exists(folder)


def _folders(spark: SparkSession, path: str, depth: int) -> set[str]:
    """Names of the partition folders ``depth`` levels below a path, one per partition."""
    if depth == 0:
        return {""}
    folder, files = _path(spark, path)
    found = [f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()]
    return {f"{name}/{rest}".rstrip("/") for name in found if "=" in name for rest in _folders(spark, f"{path}/{name}", depth - 1)}


def is_pending(spark: SparkSession, staging: str) -> bool:
    """Whether staged rows are complete and not yet, or not wholly, in place."""
    try:
        return not spark.read.schema("id bigint").parquet(f"{staging}/ready").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def finish_pending(
    spark: SparkSession, path: str, staging: str, schema: T.StructType, partition_by: Sequence[str]
) -> bool:
    """Complete a replacement that died while moving in; must run before a cursor reads the table.

    Otherwise a replaced newest partition would advance the cursor past older partitions that
    were not replaced yet.
    """
    pending = is_pending(spark, staging)
    if pending:
        move_in(spark, path, staging, schema, partition_by)
    return pending


def as_replaced(
    spark: SparkSession, path: str, staging: str, schema: T.StructType, partition_by: Sequence[str]
) -> DataFrame:
    """The table at ``path`` as it is once a pending replacement has moved in, whatever the state it is in now."""
    merged = spark.read.schema(schema).parquet(f"{staging}/merged")
    if not has_folder(spark, f"{staging}/touched") or not has_folder(spark, path):
        return merged
    by = T.StructType([schema[c] for c in partition_by])
    touched = spark.read.schema(by).parquet(f"{staging}/touched")
    old = spark.read.schema(schema).parquet(path)
    return _join_on(old, touched, partition_by, "left_anti").unionByName(merged)


def _mark(spark: SparkSession, staging: str, ready: bool) -> None:
    spark.range(int(ready)).coalesce(1).write.mode("overwrite").parquet(f"{staging}/ready")


def touched_partitions(
    target: DataFrame, arriving: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Target rows in the partitions that occur in the batch.

    The bounds are scalar subqueries, which prune partition folders without collecting the
    batch's values; the semi-join then drops partitions in between that did not arrive. Its
    right side is one small row per arriving partition, which Spark broadcasts by its measured
    size; beyond that it splits a left side that one big partition makes uneven.
    """
    rows = target
    for name in partition_by:
        lowest, highest = (
            arriving.agg(bound(name).alias("bound")).scalar() for bound in (F.min, F.max)
        )
        rows = rows.where(F.col(name).between(lowest, highest) | F.col(name).isNull())
    return _join_on(rows, arriving.select(*partition_by).distinct(), partition_by, "left_semi")


def open_or_create(
    spark: SparkSession, path: str, like: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """The table at ``path`` in the batch's columns; created without rows before the first load."""
    like.limit(0).write.mode("ignore").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)
