"""Every query against its DuckDB statement, on the shared tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


OWN = {**entry.catalog.DATASETS, **entry.catalog.REPORTS, **entry.records.RECORDS,
       **entry.operations.OPERATIONS}


def test_every_query_has_a_statement():
    assert set(OWN) <= set(entry.queries())
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_statement(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
