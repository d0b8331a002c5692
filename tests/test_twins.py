"""Every registered query against its SQL twin."""

import os

import pytest

import twins

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    with twins.connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_a_twin():
    assert set(twins.QUERIES) == set(twins.ORACLE)


@pytest.mark.parametrize("name", sorted(twins.QUERIES))
def test_query_equals_its_twin(spark, tables, name):
    twins.compare(spark, tables, SF_DIR, name)


def test_entry_has_the_report_columns(spark):
    import __spark_entry__
    from shelflife.schemas import READINESS

    report = __spark_entry__.entry(spark)
    assert report.columns == READINESS.fieldNames()
    assert report.count() > 0
