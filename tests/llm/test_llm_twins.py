"""Every operator query that SQL can express, against its SQL twin."""

import os

import pytest
import twins

from shelflife.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, monkeypatch, name):
    monkeypatch.setitem(twins.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(twins.ORACLE, name, ORACLE[name])
    with twins.connect(SF_DIR) as connection:
        twins.compare(spark, connection, SF_DIR, name)
