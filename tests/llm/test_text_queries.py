"""The operators' registered queries: with SQL against DuckDB, the others for rows and columns."""

import os

import pytest

import check_oracles
from orderflow.llm.oracles import ORACLES
from orderflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are absent")
COLUMNS = {
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_token_counts": ["doc_id", "n_tokens", "score"],
    "op9_licenses": ["doc_id", "n_paragraphs", "families", "at"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    same, text = check_oracles.compare(spark, check_oracles.connect(SF_DIR), SF_DIR, name)
    assert same, text


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert result.columns == COLUMNS[name] and set(QUERIES) == {*COLUMNS, *ORACLES}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = sorted(r.doc_id for r in result.collect())
    assert ids == sorted(r.doc_id for r in documents.select("doc_id").collect())
