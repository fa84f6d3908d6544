"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token store.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which the next stage gets as docs after it was written and read again. All but the last return the
columns of ``docs``. Each stage works on all rows it is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.llm import decontaminate, mixing, ngram_join, quality_rules, token_store
from cindergrid.session import work_folder


def _held(docs: DataFrame) -> DataFrame:
    """``row`` (all columns but the text) and ``text``: whatever the columns are called, no name of ours meets theirs."""
    others = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row") if others else F.lit(True).alias("row"), "text")


def _released(held: DataFrame, columns: list[str]) -> DataFrame:
    return held.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, judged against the languages of these documents.

    A NULL or empty text goes; repeated rows stay or go alike; an empty table stays empty.
    """
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by shingle similarity: the one with the least doc_id.

    Rows are told by doc_id and 128 bits of the text, so texts that share an id are judged apart, and texts
    are shuffled once. Rows that repeat both go too; other rows without a doc_id stay, as do texts without words.
    """
    named = [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")]
    key = F.coalesce(F.unhex(F.md5("text")), F.lit(b"")).alias("key")
    row = F.struct(named[0], F.col("doc_id").alias("id"), named[1], key)
    found = ngram_join.join(docs.select(row.alias("doc_id"), "text"))
    stay = found.where("doc_id.none OR doc_id = component_id").select("doc_id.none", "doc_id.name", "doc_id.key").distinct()
    held = _held(docs).withColumns({"none": F.col("row.doc_id").isNull(), "name": F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")), "key": key})
    # The join has rows of one key together, where the second of them goes without another shuffle.
    return _released(held.join(stay, ["none", "name", "key"], "left_semi").dropDuplicates(["none", "name", "key"]), docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; NULL and empty texts and repeated rows stay."""
    found = decontaminate.scan(_held(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _released(found.where(F.size("__spans") == 0), docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole: the part of a pass is rounded by a seeded draw.

    So a source's words come near its target over its documents, and no document is cut. Rows are told by
    doc_id, text and source, so those without a doc_id or with one in common each get their own copies;
    equal rows share theirs evenly, and texts without words are never taken.
    """
    key = F.xxhash64("text")
    taken = mixing.mix(docs, key=key).where("size > 0").groupBy("doc_id", "source", "row_key")
    taken = taken.agg(F.sum("size").alias("size"), F.sum("taken").alias("taken")).where("taken > 0")
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit(""), "row_key", "source"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("copies:"), named)), 1, 8), 16, 10).cast("long")
    rest = (F.pmod("taken", "size") / F.col("size")) * F.lit(2**32) > draw
    copies = (F.floor(F.col("taken") / F.col("size")) + rest.cast("long")).cast("int")
    counted = taken.select("doc_id", "source", "row_key", copies.alias("copies")).where("copies > 0")
    held = _held(docs)
    same = held["row.doc_id"].eqNullSafe(counted["doc_id"]) & held["row.source"].eqNullSafe(counted["source"]) & (F.xxhash64(held["text"]) == counted["row_key"])
    repeated = held.join(counted, same).select("row", "text", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return _released(repeated, docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each row's ids in the written token store; a NULL text has the end id alone."""
    import public_tokenizers

    path = work_folder(spark, "corpus-tokens")
    token_store.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("n-gram join", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token store", tokens),
]

#: The last stage tokenises, which SQL can't express; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, f"corpus-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
