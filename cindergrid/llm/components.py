"""Connected components of an edge table by alternating large and small stars, on stored tables.

Tasks first reduce the edges they have, a bounded number, to forests. Then each round keeps the
components, and every node ends up at the smallest node of its own. A round is two aggregates that
combine map-side and two joins, which Spark splits where a star has many rays. Rounds are stored in the work folder, so a lost executor costs tasks, never the whole chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindergrid.llm.scratch import Scratch
from cindergrid.llm.words import importable

#: Edges that one task reduces; some 200 bytes each while it does.
TASK_EDGES = 500_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v) with u > v, every node's larger (or smaller) neighbours tied to its least one."""
    if large:
        seen = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")) if large else seen.groupBy("u").agg(F.min("v").alias("m"))
    tied = seen.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _forest(edges: DataFrame) -> DataFrame:
    """The edges of each task, reduced to one edge (u, v) from every node to the least it is connected to."""
    kind = edges.schema["a"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.binary()

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def root(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(up.setdefault(a, a)), root(up.setdefault(b, b))
                if x != y:
                    up[max(x, y)] = min(x, y)
        found = [(x, root(x)) for x in up]
        rays = [(x, r) for x, r in found if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in rays], arrow), pa.array([r for _, r in rays], arrow)], names=["u", "v"]
        )

    return edges.mapInArrow(contract, f"u {kind}, v {kind}")


def components(edges: DataFrame, label: str = "components", task_edges: int = TASK_EDGES) -> DataFrame:
    """``node, component`` for every node (long or binary) of the edges (a, b), a <> b; the component is its smallest node.

    First each task reduces at most about ``task_edges`` of the edges to a forest, which is the answer if
    one task has them all; else the rounds join the forests.
    """
    spark = edges.sparkSession
    importable(spark)
    scratch = Scratch(spark, label)

    def stored(rows: DataFrame, name: str) -> DataFrame:
        """The only table that is still needed."""
        table = scratch.store(rows, name)
        scratch.free(table)
        return table

    pairs = stored(edges.where("a <> b").select("a", "b"), "edges")
    tasks = max(1, -(-pairs.count() // task_edges))
    now = stored(_forest(pairs.coalesce(tasks)), "forest")
    while tasks > 1:
        # Done when every node has one edge, to a node that has none.
        twice = now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        further = now.select(F.col("v").alias("u")).join(now.select("u"), "u", "left_semi")
        if twice.unionAll(further).isEmpty():
            break
        now = stored(_star(_star(now, True), False), "round")
    rays = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return rays.unionByName(centres)
