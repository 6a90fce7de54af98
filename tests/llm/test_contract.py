"""The registered queries: SQL where there is some, shape and determinism for the others."""

import duckdb
import pytest
from conftest import rows_of, rows_of_sql

import __spark_entry__ as contract
from tillmart.llm import oracle
from tillmart.llm.queries import registry

COLUMNS = {
    "op1_quality": {"doc_id", "held_out", "score", "predicted"},
    "op2_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op3_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op4_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op5_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op6_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op7_line_dedup": {"doc_id", "n_lines", "n_dropped"},
    "op8_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op10_spotsigs": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op11_merkle": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op12_conversations": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    "op13_toxicity": {"doc_id", "held_out", "score", "predicted"},
}


@pytest.fixture(scope="module")
def llm_duck(folder):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(oracle.ORACLE))
def test_query_equals_sql(spark, llm_duck, folder, name):
    names, rows = rows_of(registry()[name](spark, folder))
    expected_names, expected = rows_of_sql(llm_duck, oracle.ORACLE[name])
    assert names == expected_names
    assert rows == expected


@pytest.mark.parametrize("name", list(COLUMNS))
def test_one_row_per_input_row(spark, folder, name):
    df = registry()[name](spark, folder)
    assert COLUMNS[name] <= set(df.columns)
    key, table = {"op5_warc": ("page_id", "pages"), "op12_conversations": ("conv_id", "conversations")}.get(name, ("doc_id", "documents"))
    wanted = spark.read.parquet(f"{folder}/{table}.parquet").select(key)
    wanted = wanted.distinct() if key == "conv_id" else wanted
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in wanted.collect())


def test_all_are_registered():
    assert {*registry(), "pipeline"} <= set(contract.queries())
    assert set(registry()) == set(COLUMNS)
