"""The registered queries of this subpackage, over the whole given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindergrid.llm import (
    decontaminate,
    hard_negatives,
    hyperminhash,
    langid,
    lexical_search,
    licenses,
    mixing,
    ngram_join,
    pii,
    quality_rules,
    secrets,
    suffix_dedup,
    token_store,
)
from cindergrid.llm.spans import written
from cindergrid.llm.sql import ORACLES  # noqa: F401
from cindergrid.operators.upsert import remove_folder
from cindergrid.session import work_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under five-word shingle similarity of 0.8 and more."""
    return ngram_join.join(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("set_id", "n_links")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document, by pattern and by the trained classifier."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[n(kind) for kind in pii.BASE],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices, exact and with bounded errors, of each document."""
    found = licenses.find_notices(_table(spark, sf_dir, "documents"))
    labels = F.array_distinct(F.array_sort(F.concat("base_labels", F.transform("spans", lambda s: s["label"]))))
    best = F.array_max(F.transform("spans", lambda s: s["score"]))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without passages of 50 bytes that an earlier one has."""
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_bytes=False)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, by pattern and by entropy."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("__base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[n(kind) for kind in secrets.BASE],
        F.sha2(written(F.col("__base")), 256).alias("base_sha256"),
        written(F.col("__spans")).alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document by a network that never saw the held-out ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a benchmark window, and the items hit."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.size("__spans") > 0).alias("contaminated"),
    )


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, read back from the written files."""
    import public_tokenizers

    path = work_folder(spark, "token-store")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, path)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    judged = quality_rules.judged(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep=["doc_id", "lang"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("row.doc_id", *[F.col(f"verdict.{c}").alias(c) for c in counts])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of each fiftieth vector; some labels are moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)


def op12_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under two-word shingle similarity of 0.8 and more, and whether it stands for it."""
    return hyperminhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("set_id")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for each benchmark item."""
    docs = _table(spark, sf_dir, "documents")
    path = work_folder(spark, "signatures")
    found = lexical_search.search(docs, lexical_search.build(docs, path), _table(spark, sf_dir, "benchmark"))
    remove_folder(spark, path)  # the answer is stored
    return found


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_personal_data": op2_personal_data,
    "op3_license_scan": op3_license_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_token_store": op8_token_store,
    "op9_source_mixing": op9_source_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_near_duplicates": op12_near_duplicates,
    "op13_lexical_search": op13_lexical_search,
}
