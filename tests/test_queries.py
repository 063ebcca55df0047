"""Every registered query against its DuckDB oracle on the smallest tables."""
import pytest

import __spark_entry__ as E
from compare import compare, duck
from pluvio.testing import suite

SF = "/root/testdata/sf0.001"
NAMES = sorted(suite.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(suite.SQL) == set(suite.QUERIES)
    assert set(suite.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert ok, detail


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "cum_exceeds" in df.columns
