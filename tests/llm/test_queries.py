"""Registered corpus queries: columns of their contracts, and the SQL where there is one."""

import os

import duckdb
import pytest

from snapmart.llm import queries

from . import data

COLUMNS = {
    "op1_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_token_counts": "doc_id n_tokens n_edits n_tokens_after",
    "op3_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_ann": "query_id rank vec_id score",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_quality": "doc_id held_out score predicted",
    "op11_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op12_ranked_search": "item_id rank doc_id score",
    "op13_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns_over_the_whole_table(spark, name):
    out = queries.REGISTRY[name](spark, data.SMALL)
    assert out.columns[:len(COLUMNS[name].split())] == COLUMNS[name].split()
    rows = out.collect()
    if name == "op12_ranked_search":
        assert len(rows) == 40 * 10
    elif name == "op13_prefix_trie":
        convs = spark.read.parquet(f"{data.SMALL}/conversations.parquet").select("conv_id").distinct().count()
        assert [r["n_convs"] for r in rows if r["depth"] == 0] == [convs]
    elif "doc_id" in out.columns:
        ids = {r["doc_id"] for r in spark.read.parquet(f"{data.SMALL}/documents.parquet").select("doc_id").collect()}
        assert {r["doc_id"] for r in rows} == ids
    else:
        assert len(rows) == 25 * 20


@pytest.mark.parametrize("name", queries.SQL)
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(data.SMALL, table)}.parquet'")
    out = queries.REGISTRY[name](spark, data.SMALL)
    want = db.sql(queries.SQL[name]).arrow().read_all().select(out.columns).to_pylist()
    assert sorted(map(tuple, out.collect()), key=str) == sorted((tuple(r.values()) for r in want), key=str)
