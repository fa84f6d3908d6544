"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources in code-point order (NULL last) weigh 5, 2, 1, repeating, and share all tokens;
a target stops at ``MAX_EPOCHS`` times its source and the excess is shared again by weight.
The mix has about ``BLOCKS`` blocks of equal tokens. The highest quotients ``target / (2k - 1)`` give
each source its integer quota, the same rule hands a source's quota to its shards, and a shard's
seeded order of blocks says which of them are taken, whole passes first.

A source of fewer than ``SHARD_BLOCKS`` of these blocks, by its size or its target, has blocks of its own:
a ``SHARD_BLOCKS``-th of the lesser of the two, at least one word. Its quota is its target in such blocks, rounded
(the same rule with the divisor of exact shares); the others deal the tokens that are left among them. So
no source is lost for being small beside the corpus, however many there are.

Shards are cut by a hash of the document and hold about ``SHARD_BLOCKS`` blocks, so a source with a
third of all rows is many shards. The windows that are not per shard run over one row per source or
over at most ``BLOCKS`` quotients more than there are sources or shards, never over documents. Finer blocks
add fewer than some hundred per source.

Defined results: a NULL text has size 0 and nothing taken; NULL is a source of its own; repeated
rows are mixed as rows of their own; an empty table gives an empty mix. No document is taken more
than ``MAX_EPOCHS`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cindergrid.llm.quality_rules import words_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCKS = 65_536
SHARD_BLOCKS = 32
SEED = "mix-1"


def _lot(*parts: Column) -> Column:
    """A reproducible 32-bit draw."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source_id, source, source_size, weight, target`` from rows (source, size).

    ``target = least(cap, lambda * weight)``: with sources by rising ``cap / weight``, the first k
    are capped for the one k where the rest, shared by weight, stays below its own caps.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("source_id", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), ((F.col("source_id") - 1) % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", MAX_EPOCHS * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_id")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left_tokens", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # The first source whose cap is not reached fixes the share of a unit of weight.
    open_ = F.col("cap") * F.col("left_weight") >= F.col("left_tokens") * F.col("weight")
    first = F.min_by(F.struct("left_tokens", "left_weight"), F.when(open_, F.struct(F.col("cap") / F.col("weight"), F.col("source_id"))))
    per = per.withColumn("unit", first.over(everything))
    share = F.col("unit.left_tokens") * F.col("weight") / F.col("unit.left_weight")
    target = F.when(F.col("cap") * F.col("unit.left_weight") <= F.col("unit.left_tokens") * F.col("weight"), F.col("cap").cast("double")).otherwise(share)
    return per.select("source_id", "source", "source_size", "weight", target.alias("target"), "total")


def _seats(rows: DataFrame, within: list[str], votes: str, seats: Column, most: Column) -> DataFrame:
    """Sainte-Lague: ``rows`` with ``quota``, the highest ``seats`` quotients votes / (2k - 1) within a group.

    ``most`` bounds the quotients that a row enters with; one more than its exact share is ample
    except for rounding, so callers pass the rounded share and two.
    """
    keys = [c for c in rows.columns]
    entered = rows.where(F.col(votes) > 0).withColumn("k", F.explode(F.sequence(F.lit(1), most.cast("int"))))
    entered = entered.withColumn("quotient", F.col(votes) / (2 * F.col("k") - 1))
    order = Window.partitionBy(*within).orderBy(F.col("quotient").desc(), keys[0], keys[1], "k")
    won = entered.withColumn("place", F.row_number().over(order)).where(F.col("place") <= seats)
    return won.groupBy(*keys).agg(F.count(F.lit(1)).alias("quota"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", blocks: int = BLOCKS, key: Column | None = None) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, taken`` in words, repeats counted.

    With ``key`` the rows also have this value of theirs as ``row_key``, to tell those that share an id.
    """
    keys = [] if key is None else ["row_key"]
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.size(words_of(F.col(text))).cast("long").alias("size"),
        *[key.alias(k) for k in keys],
    )
    common = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("total") / F.lit(blocks)).cast("long"))
    own = F.floor(F.least(F.col("source_size"), F.col("target")) / SHARD_BLOCKS).cast("long")
    targets = source_targets(sized).withColumn("common", common)
    targets = targets.withColumn("block", F.greatest(F.lit(1).cast("long"), F.least("common", own)))
    everyone = targets.withColumn("fine", F.col("block") < F.col("common"))
    # Blocks of a fine source hold source_size / ceil(source_size / block) words, as its last one is shorter.
    in_own = F.round(F.col("target") * F.ceil(F.col("source_size") / F.col("block")) / F.col("source_size")).cast("long")
    fine = everyone.where("fine").select("source_id", in_own.alias("quota"))
    apart = everyone.agg(F.coalesce(F.sum(F.when(F.col("fine"), F.col("target"))), F.lit(0.0)).alias("apart"))
    dealt = everyone.where("NOT fine").crossJoin(F.broadcast(apart))
    dealt = dealt.withColumn("seats", F.round((F.col("total") - F.col("apart")) / F.col("block")).cast("long"))
    share = F.floor(F.col("target") / F.col("block")) + 2
    quotas = _seats(dealt.select("source_id", "target", "block", "seats"), [], "target", F.col("seats"), share)
    quotas = quotas.select("source_id", "quota").unionByName(fine).withColumnRenamed("quota", "source_quota")
    everyone = everyone.select("source_id", "source", "source_size", "target", "block")
    sources = everyone.join(quotas, "source_id", "left").withColumn(
        "n_shards", F.greatest(F.lit(1).cast("long"), F.floor(F.col("source_size") / (SHARD_BLOCKS * F.col("block"))).cast("long"))
    )
    rows = sized.join(sources.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    rows = rows.withColumn("shard", F.pmod(_lot(F.lit("shard"), F.col("doc_id")), F.col("n_shards")))
    in_order = Window.partitionBy("source_id", "shard").orderBy(_lot(F.lit("order"), F.col("doc_id")), "doc_id", "size", *keys)
    rows = rows.withColumn("place", F.row_number().over(in_order)).withColumn(
        "start", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    shards = rows.groupBy("source_id", "shard", "block", "source_size", "source_quota").agg(F.sum("size").alias("shard_size"))
    shards = shards.where("shard_size > 0").withColumn("n_blocks", F.ceil(F.col("shard_size") / F.col("block")).cast("long"))
    share = F.floor(F.col("source_quota") * F.col("shard_size") / F.col("source_size")) + 2
    shard_quotas = _seats(
        shards.select("source_id", "shard", "block", "shard_size", "n_blocks", "source_quota", "source_size"),
        ["source_id"], "shard_size", F.col("source_quota"), share,
    ).withColumn("quota", F.least("quota", MAX_EPOCHS * F.col("n_blocks")))
    drawn = shard_quotas.select(
        "source_id", "shard", "block", "n_blocks",
        F.floor(F.col("quota") / F.col("n_blocks")).cast("long").alias("passes"),
        F.pmod("quota", "n_blocks").alias("extra"),
    )
    # A shard's extra blocks, by seeded draw.
    lots = drawn.where("extra > 0").withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    by_lot = Window.partitionBy("source_id", "shard").orderBy(_lot(F.lit("block"), F.col("source_id"), F.col("shard"), F.col("b")), "b")
    chosen = lots.withColumn("rank", F.row_number().over(by_lot)).where("rank <= extra").select("source_id", "shard", "b", "block")
    size, start, block = F.col("size"), F.col("start"), F.col("block")
    # One row per document and block that it touches: no more than blocks and documents together.
    pieces = rows.where("size > 0").select("source_id", "shard", "place", "size", "start", "block").withColumn(
        "b", F.explode(F.sequence(F.floor(start / block).cast("long"), F.floor((start + size - 1) / block).cast("long")))
    )
    pieces = pieces.join(chosen.drop("block"), ["source_id", "shard", "b"], "left_semi")
    overlap = F.least(start + size, (F.col("b") + 1) * block) - F.greatest(start, F.col("b") * block)
    partly = pieces.groupBy("source_id", "shard", "place").agg(F.sum(overlap).alias("partly"))
    out = rows.join(drawn.select("source_id", "shard", "passes"), ["source_id", "shard"], "left").join(
        partly, ["source_id", "shard", "place"], "left"
    )
    taken = F.coalesce("passes", F.lit(0)) * size + F.coalesce("partly", F.lit(0))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *keys)
