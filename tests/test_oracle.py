"""Every registered query against its SQL oracle (driver contract), sf0.01."""
import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from oracle_compare import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF_ORACLE), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_ORACLE).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event", "category_ids", "date", "avg_magnitude"]


def test_contract_shapes():
    assert set(ORACLES) <= set(QUERIES)
    assert SF_SMALL
