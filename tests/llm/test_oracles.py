"""The registered queries against their SQL."""

import os

import pytest

from salesflow.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_answers_every_document(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
