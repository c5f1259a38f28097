"""Registered corpus queries: against their SQL, and the columns that the contracts fix."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from aerolake.llm.register import QUERIES, STATEMENTS
from tests import compare

COLUMNS = {
    "op1_urls": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op2_onebit": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op4_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op11_ranked": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op13_negatives": {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
        "positive_score": "bigint", "negative_score": "bigint",
    },
    "op9_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
}


def test_all_operators_and_the_pipeline_are_offered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names}
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    columns, rows = compare.spark_table(QUERIES[name](spark, sf_dir))
    con = compare.connect(sf_dir)
    expected_columns, expected = compare.duck_table(con, STATEMENTS[name])
    con.close()
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    made = dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
    assert COLUMNS[name].items() <= made.items()
