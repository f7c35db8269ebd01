"""Gold, screening and alert reports as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskview.operators.quality import count_if_summary

#: Alert name -> the flag of the gold view that raises it.
ALERTS: Mapping[str, str] = {"aml": "aml_flag", "dormancy": "dormancy_alert",
                             "high_risk_profile": "high_risk_profile"}


def gold_summary(gold: DataFrame) -> DataFrame:
    """One row: customers, customers per risk level, customers per alert."""
    level = F.col("kyc_risk_level")
    return count_if_summary(gold, {
        "high": level == "HIGH", "medium": level == "MEDIUM", "low": level == "LOW",
        "aml": F.col("aml_flag"), "dormancy": F.col("dormancy_alert"),
        "high_risk": F.col("high_risk_profile")})


def risk_distribution(gold: DataFrame) -> DataFrame:
    """Customers per risk level, in order of the level."""
    return (gold.groupBy("kyc_risk_level").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("kyc_risk_level"))


def screen_summary(screened: DataFrame) -> DataFrame:
    """One row: customers screened, hits, and customers without one."""
    return (count_if_summary(screened, {"hits": F.col("aml_flag"), "clean": ~F.col("aml_flag")})
            .withColumnRenamed("total", "screened"))


def alert_list(gold: DataFrame, alerts: Mapping[str, str] = ALERTS) -> DataFrame:
    """One row per raised alert (alert_type, customer_id), from one pass."""
    raised = F.filter(F.array(*[F.when(F.col(c), F.lit(t)) for t, c in alerts.items()]),
                      lambda x: x.isNotNull())
    return gold.select(F.explode(raised).alias("alert_type"), "customer_id")


def preview(gold: DataFrame, rows: int = 10) -> DataFrame:
    """The first customers by id."""
    return gold.orderBy("customer_id").limit(rows)
