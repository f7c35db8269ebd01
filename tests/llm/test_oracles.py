"""Queries with SQL against DuckDB, and every query's shape and row count."""

import pytest

from riskview.llm.oracle import ORACLES
from riskview.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

TABLE = {"op10_url_rules": "pages", "op13_metric_join": "embeddings"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    ok, message = compare(spark, duck(SF_SMALL), name, SF_SMALL)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_exact_topk", "op11_filter_audit"}))
def test_one_row_a_document(spark, name):
    table = TABLE.get(name, "documents")
    out = QUERIES[name](spark, SF_SMALL)
    key = {"pages": "page_id", "embeddings": "vec_id"}.get(table, "doc_id")
    want = sorted(r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in out.select(key).collect()) == want
