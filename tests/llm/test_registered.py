"""Every registered query on the smallest tables: next to its SQL, or by its columns."""

import os

import corpus_pipeline
import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from docpulse.llm.common import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    return con


def test_one_query_for_each_operator():
    import docpulse.llm.registry  # noqa: F401

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", ["op2_chat_format", "op7_licence_scan", "op8_url_filter", "op9_exact_dedup", "op10_topk", "op12_lexical"])
def test_query_and_sql(spark, db, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = db.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(map(repr, theirs)) == sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


CONTRACTS = {
    "op1_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op3_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op5_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op10_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op11_reshard": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int, old_shard int",
    "op12_lexical": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op13_spelling": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract(spark, name):
    df = queries()[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == CONTRACTS[name]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
    out = queries()["pipeline"](spark, SF)
    assert 0 < out.count() and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = {r.doc_id for r in out.collect()}
    assert ids == {r.doc_id for r in kept.select("doc_id").collect()}


def test_pipeline_without_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
