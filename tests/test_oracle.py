"""Every registered query against its DuckDB oracle (sf0.001 for speed;
the driver repeats this at sf0.01)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

from __spark_entry__ import oracle_sql
from riskview.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() == 150
    assert "kyc_risk_level" in df.columns and len(df.columns) == 23
