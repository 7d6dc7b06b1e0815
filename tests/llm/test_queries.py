"""The registered training-data queries: entry module, DuckDB SQL where there is one, contract columns."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ridestat.llm import queries as training

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_top_k": ["query_id", "rank", "vec_id", "score"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_page_text": ["page_id", "url", "text", "n_chars"],
    "op6_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_url_rules": ["page_id", "host", "path", "rule", "verdict"],
    "op8_line_dedup": ["doc_id", "text", "n_lines", "n_removed"],
    "op9_near_dup": ["doc_id", "class_id", "kept"],
    "op10_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op11_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


def test_all_are_registered():
    assert set(training.queries()) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())
    assert set(training.oracle_sql()) <= set(COLUMNS)


@pytest.mark.parametrize("name", sorted(training.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{os.path.join(SF, t)}.parquet'")
    want = con.execute(training.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = training.queries()[name](spark, SF).select(*columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
    assert got.columns == COLUMNS[name]


@pytest.mark.parametrize("name", ["op4_bpe", "op5_page_text", "op6_token_files", "op10_mix_sources"])
def test_query_covers_its_table(spark, name):
    table = "pages" if name == "op5_page_text" else "documents"
    out = training.queries()[name](spark, SF)
    assert out.columns[: len(COLUMNS[name])] == COLUMNS[name]
    assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
