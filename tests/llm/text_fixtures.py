from __future__ import annotations

import random

import pytest
import text_brute as brute
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors():
    """NULLs everywhere, values that are no numbers, empty and short vectors, ties, repeated rows, shared ids."""
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0.2, 1) for _ in range(6)], rng.randrange(3)) for i in range(400)]
    same = [0.5, -0.25, 1.0, 0.0, 0.0, 2.0]
    rows += [(i, same, i % 4) for i in range(400, 520)]
    rows += [(550, same, 1), (550, same, 1), (550, same, 2), (550, [0.0] * 6, 1), (600, [], 1), (601, [], 1), (602, [], 2), (650, [3.0], 5), (651, [2.0], 5), (652, [1.5], 4)]
    rows += [(None, same, 1), (700, None, 1), (750, same, None), (800, [None, *same[1:]], 1), (850, [float("nan"), *same[1:]], 1), (900, [float("inf"), *same[1:]], 1)]
    rows += [(-50, [-x for x in same], 0), (-100, [1e-9] * 6, 0), (-51, [-1e-9] * 6, 0)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return brute.awkward()


@pytest.fixture(scope="session")
def folder(spark, rows, tmp_path_factory):
    """The awkward documents, as tables on disk, with a benchmark made of some of their words."""
    path = str(tmp_path_factory.mktemp("awkward"))
    docs = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    passage = " ".join((rows[14][1] or "").split()[45:70])
    items = [(1, passage), (2, "one two three"), (3, None), (4, ""), (None, "apache licence"), (2, "one two three"), (10, passage.upper())]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(vectors(), VECTORS).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="session")
def items(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], VECTORS).write.parquet(f"{path}/embeddings.parquet")
    return path


CLASHES = "id name key number n times registers hashes group run dims anchor vector kinds rank item low high near linked place n_words n_shingles set_id component_id row text_ __text __words __quality __id __key __source __copies __copy __spans __items __n_words __once name copy copies verdict words hashes size source_size target taken spans base kept n_bytes lang_pred score part seq start b block place shard match bucket".split()


@pytest.fixture(scope="session")
def crowded(spark, folder, docs, tmp_path_factory):
    """The same rows, each twice, with columns named like those the operators make."""
    path = str(tmp_path_factory.mktemp("crowded"))
    wide = docs.unionByName(docs)
    for name in CLASHES:
        wide = wide.withColumn(name, F.lit(name) if name != "n_words" else F.array(F.lit(1.5)))
    wide.write.parquet(f"{path}/documents.parquet")
    for table in ("benchmark", "embeddings"):
        more = spark.read.parquet(f"{folder}/{table}.parquet")
        more = more.withColumns({c: F.lit(c) for c in CLASHES})
        more.write.parquet(f"{path}/{table}.parquet")
    return path

