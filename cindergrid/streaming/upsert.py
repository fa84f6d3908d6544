"""Incremental upsert: each micro-batch is merged into the table, the checkpoint is the cursor."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cindergrid.operators.upsert import upsert_parquet


def run_upsert(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    version: str = "extracted_at",
    accept: Callable[[DataFrame], DataFrame] | None = None,
    before: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Merge everything available into ``path``.

    A batch that is replayed after a failure first completes what the lost try had begun to
    move in, then finds its own rows and replaces them, so at-least-once delivery gives an exact
    table. ``accept`` turns a micro-batch into the rows to merge; ``before`` sees them before they are merged.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        # One staging folder per stream: whatever a lost try left there is completed first.
        upsert_parquet(
            batch.sparkSession, path, accept(batch) if accept else batch, keys, partition_by, version,
            staging=f"{checkpoint}-staging", before=before,
        )

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
