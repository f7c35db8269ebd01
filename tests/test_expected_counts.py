"""Counts stated for the fixtures at sf0.001 (computed independently by DuckDB)."""

from riskview.plans import catalog
from tests.conftest import SF_SMALL


def test_gold_summary(spark):
    r = catalog.QUERIES["gold_summary"](spark, SF_SMALL).first()
    assert (r.total, r.high, r.medium, r.low) == (150, 33, 84, 33)
    assert (r.aml, r.dormancy, r.high_risk) == (10, 16, 2)


def test_velocity_distribution(spark):
    got = dict(catalog.QUERIES["velocity_distribution"](spark, SF_SMALL).collect())
    assert got == {"HIGH": 50, "MEDIUM": 49, "LOW": 46}


def test_scd2_counts(spark):
    r = catalog.QUERIES["scd2_summary"](spark, SF_SMALL).first()
    changed = catalog.QUERIES["scd2_changed_keys"](spark, SF_SMALL).count()
    assert changed == 38
    assert (r.current, r.expired) == (150 - 0 + 3, 38)


def test_dedup_lineitem_count(spark):
    assert catalog.QUERIES["dedup_lineitem"](spark, SF_SMALL).count() == 4599


def test_risk_score_range(spark):
    from pyspark.sql import functions as F
    r = catalog.QUERIES["risk_score"](spark, SF_SMALL).agg(
        F.min("risk_score"), F.max("risk_score"), F.sum("risk_score")).first()
    assert tuple(r) == (0, 10, 634)
