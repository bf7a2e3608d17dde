"""Every query against its SQL counterpart on the smallest data."""

import pytest
from compare import DATA, connect, difference
from conftest import ROOT  # noqa: F401

from jobsieve.catalog.oracle import ORACLE
from jobsieve.catalog.queries import QUERIES

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
