"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from aerolake.plans.register import QUERIES
from oracle.statements import STATEMENTS as ORACLE
from tests import compare


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = compare.connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_counterpart(spark, duck, sf_dir, name):
    columns, rows = compare.spark_table(QUERIES[name](spark, sf_dir))
    expected_columns, expected = compare.duck_table(duck, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    for got, want in zip(rows, expected):
        assert got == want


def test_entry_runs(spark):
    assert contract.entry(spark).select("event_id").distinct().count() == 1000
