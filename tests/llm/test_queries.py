"""The queries with a twin, and the column types that their contracts name."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from llm import queries
from tools.check import TABLES, rows_of

FOLDER = driver.SMALLEST
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")

TYPES = {
    "op1_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op2_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op4_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op5_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_language_model": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op11_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
}


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_its_sql(spark, twin, name):
    df = queries.QUERIES[name](spark, FOLDER)
    want = twin.sql(queries.SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", TYPES)
def test_types(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == TYPES[name]


OTHER_ROWS = ("op11_conversation_repair", "op12_spelling_variants")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in OTHER_ROWS])
def test_one_row_a_document(spark, name):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    got = queries.QUERIES[name](spark, FOLDER).count()
    assert got == rows or name == "pipeline" and 0 < got <= rows
