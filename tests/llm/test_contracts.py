"""Columns and types of the registered queries, and their SQL at the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sigspark.llm import queries

DATA = "/root/testdata/sf0.001"
CONTRACTS = {
    "op1_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op2_quality_classifier": "doc_id bigint, quality_own double, quality_posterior double, toxic_own double, toxic_posterior double, keep boolean",
    "op3_media_columns": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op4_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans string",
    "op5_sentencepiece": "doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids_sha256 string, round_trip boolean",
    "op6_suffix_array_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op7_language_id": "doc_id bigint, lang string, lang_id string, lang_posterior double, lang_text string, keep boolean",
    "op8_chat_formatting": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op9_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op10_secret_scans": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op12_lloyd": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def test_all_are_registered():
    assert set(queries.QUERIES) == set(CONTRACTS)
    assert set(CONTRACTS) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_and_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    types = dict(df.dtypes)
    for c in CONTRACTS[name].split(", "):
        column, kind = c.split(" ")
        assert types[column] == kind
    got = sorted((tuple(map(str, r)) for r in df.collect()))
    assert got
    if name in queries.ORACLE:
        columns = ", ".join(f'"{c}"' for c in df.columns)
        want = con.execute(f"SELECT {columns} FROM ({queries.ORACLE[name]})").fetchall()
        assert got == sorted(tuple(map(str, r)) for r in want)
