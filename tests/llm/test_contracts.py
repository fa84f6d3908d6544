"""Every registered query against its plain version, on awkward documents and the smallest tables."""

from __future__ import annotations

import duckdb
import public_tokenizers
import pytest
import text_brute as brute
from text_fixtures import SMALL, crowded, docs, empty, folder, items, rows  # noqa: F401
from tokenizers import Tokenizer

from cindergrid.llm.queries import ORACLES, QUERIES

SCHEMAS = {
    "op1_ngram_join": "doc_id bigint,n_shingles bigint,component_id bigint",
    "op2_personal_data": "doc_id bigint,n_email bigint,n_ip bigint,n_card bigint,n_phone bigint,base_sha256 string,spans string",
    "op3_license_scan": "doc_id bigint,n_words bigint,n_base bigint,first_word bigint,last_word bigint,base_labels string,labels string,score double",
    "op4_suffix_dedup": "doc_id bigint,n_bytes bigint,n_removed bigint,n_spans bigint,kept_sha256 string",
    "op5_secret_scan": "doc_id bigint,n_assign bigint,n_access bigint,n_hex bigint,base_sha256 string,spans string",
    "op6_language_id": "doc_id bigint,held_out boolean,lang_pred string,score double",
    "op7_decontamination": "doc_id bigint,n_words bigint,n_hit bigint,n_items bigint,items_sha256 string,contaminated boolean",
    "op8_token_store": "doc_id bigint,start bigint,n_tokens bigint,ids_crc32 bigint",
    "op9_source_mixing": "doc_id bigint,size bigint,source_size bigint,target double,taken bigint",
    "op10_quality_rules": "doc_id bigint,n_words bigint,word_chars bigint,n_symbols bigint,n_dup_lines bigint,n_repeat_words bigint,base_failed boolean,kept boolean",
    "op11_hard_negatives": "anchor_id bigint,positive_id bigint,rank int,negative_id bigint,positive_score bigint,negative_score bigint",
    "op12_near_duplicates": "doc_id bigint,n_shingles bigint,component_id bigint,kept boolean",
    "op13_lexical_search": "item_id bigint,rank int,doc_id bigint,score bigint",
}
#: Queries with one row per document, and those that answer something else.
PER_DOCUMENT = sorted(set(QUERIES) - {"op11_hard_negatives", "op13_lexical_search"})


def expected(name, rows, items):
    """Per id the columns that the contract fixes."""
    docs = [(i, t) for i, t, *_ in rows]
    if name.startswith("op1_"):
        return brute.components(docs)
    if name.startswith("op12_"):
        return {i: (*c, i == c[1]) for i, c in brute.components(docs, 2).items()}
    if name.startswith("op2_"):
        found = {i: brute.personal(t) for i, t in docs}
        return {i: (*[sum(k == kind for k, *_ in s) for kind in ("email", "ip", "card", "phone")], brute.sha(brute.written(s))) for i, s in found.items()}
    if name.startswith("op5_"):
        found = {i: brute.secrets(t) for i, t in docs}
        return {i: (*[sum(k == kind for k, *_ in s) for kind in ("assign", "access", "hex")], brute.sha(brute.written(s))) for i, s in found.items()}
    if name.startswith("op3_"):
        out = {}
        for i, t in docs:
            w, places = brute.folded(t), []
            for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
                p = phrase.split()
                places += [(k, label) for k in range(len(w)) if w[k : k + len(p)] == p]
            starts = [k for k, _ in places]
            out[i] = (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        return out
    if name.startswith("op4_"):
        return {i: tuple(r) for i, *r in brute.passages(docs)}
    if name.startswith("op7_"):
        return {i: (*(c := brute.contaminated(t, items)), c[1] > 0) for i, t in docs}
    if name.startswith("op8_"):
        tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        return {i: tuple(r) for i, *r in brute.store(docs, tokenizer)}
    return None


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_awkward_documents(spark, folder, rows, items, name):
    df = QUERIES[name](spark, folder)
    assert ",".join(f"{c} {t}" for c, t in df.dtypes) == SCHEMAS[name]
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    assert sorted(got) == sorted(i for i, *_ in rows)
    want = expected(name, rows, items)
    if want is not None:
        assert {i: r[: len(want[i])] for i, r in got.items()} == want
    if name in ORACLES:
        assert against_oracle(spark, folder, name)


def against_oracle(spark, path, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/{table}.parquet{'/*.parquet' if path != SMALL else ''}')")
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    df = QUERIES[name](spark, path)
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr(r) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want
    return True


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_on_the_smallest_tables(spark, name):
    assert against_oracle(spark, SMALL, name)


@pytest.mark.parametrize("name", ["op1_ngram_join", "op12_near_duplicates", "op2_personal_data", "op4_suffix_dedup", "op5_secret_scan", "op8_token_store"])
def test_plain_version_on_the_smallest_tables(spark, name):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    want = expected(name, rows, [])
    got = {r[0]: tuple(r)[1:] for r in QUERIES[name](spark, SMALL).collect()}
    assert {i: r[: len(want[i])] for i, r in got.items()} == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_repeated_rows_and_clashing_columns(spark, crowded, rows, name):
    """Each row comes out twice; columns of the input named like ours change nothing."""
    got = [tuple(r) for r in QUERIES[name](spark, crowded).collect()]
    assert sorted(r[0] for r in got) == sorted(2 * [i for i, *_ in rows])
    if name[:4] in ("op1_", "op3_", "op4_", "op5_", "op7_", "op12"):
        plain = [repr(tuple(r)) for r in QUERIES[name](spark, crowded).distinct().collect()]
        assert sorted(repr(r) for r in got) == sorted(2 * plain)
