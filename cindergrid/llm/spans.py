"""Places of regular-expression matches as columns: what is found and where, in code points.

Spark has no function for the places of matches. The matches and the pieces between them, from
``regexp_extract_all`` and ``split`` with the same pattern, give them by their lengths. Patterns must not
match the empty string; possessive quantifiers keep Java's matcher from recursing on very long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KIND = "array<struct<start:int,end:int,match:string>>"


def with_spans(docs: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Adds one array of (start, end, match) per named pattern: leftmost, not overlapping, in order."""
    t = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumns({f"{n}__m": F.regexp_extract_all(t, F.lit(p), F.lit(0)) for n, p in patterns.items()})
    placed = {n: _placed(t, p, F.col(f"{n}__m")) for n, p in patterns.items()}
    return docs.withColumns(placed).drop(*[f"{n}__m" for n in patterns])


def _placed(text: Column, pattern: str, found: Column) -> Column:
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + x["gap"]
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"))
        return F.struct(end.alias("at"), F.concat(seen["out"], F.array(one)).alias("out"))

    empty = F.array().cast(KIND)
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(found) > 0, walked).otherwise(empty)


def overlaps(one: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (one["start"] < o["end"]) & (o["start"] < one["end"]))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the order given."""
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def of_kind(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (rank, start, end, kind), so that sorting goes by kind, then start."""
    return F.transform(
        spans,
        lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )
