"""The unified customer view as one lazy plan.

Every signal is reduced to one row per customer *before* it meets the
customer rows (velocity by partial/final aggregation, documents and accounts
by a partial top-1), so the left joins cannot fan out.  All joins but the
name screen are on ``customer_id``: each aggregated signal is already hash
partitioned on it, so the chain shuffles the customers once for the id joins
and each signal once.  Broadcast is left to the planner's size checks (and
AQE's runtime statistics), never forced for inputs that grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.config import RiskConfig
from riskview.operators.cleaning import latest_per_customer, most_recent_account
from riskview.operators.scd2 import current_rows
from riskview.operators.scoring import (is_dormant, velocity_profile, velocity_risk,
                                        with_alerts, with_risk)
from riskview.operators.screening import with_aml_flag
from riskview.schemas import GOLD_COLUMNS

CUSTOMER_COLUMNS = ("customer_id", "full_name", "country", "customer_segment",
                    "pep_flag", "effective_from", "effective_to", "is_current")
VELOCITY_COLUMNS = ("txn_count", "txn_total_amt", "cross_border_count",
                    "velocity_risk")
DOCUMENT_COLUMNS = ("doc_status", "expiry_date")
ACTIVITY_COLUMNS = ("dormant_flag", "days_since_activity", "balance_tier")


@dataclass(frozen=True)
class Inputs:
    """Silver-level inputs of the gold layer."""
    customers: DataFrame      # SCD2 history (all versions) of customer rows
    transactions: DataFrame
    documents: DataFrame
    watchlist: DataFrame
    activity: DataFrame
    unique_documents: bool = False  # documents already hold one row per customer


def signals(inp: Inputs, cfg: RiskConfig = RiskConfig(),
            velocity_window_days: int | None = None,
            as_of: str | None = None) -> DataFrame:
    """One row per current customer with every signal left-joined."""
    cust = current_rows(inp.customers).select(*CUSTOMER_COLUMNS)
    screened = with_aml_flag(cust, inp.watchlist)
    vel = velocity_risk(velocity_profile(inp.transactions, cfg.velocity,
                                         velocity_window_days, as_of), cfg.velocity)
    doc = inp.documents if inp.unique_documents else latest_per_customer(inp.documents)
    doc = doc.select("customer_id", *DOCUMENT_COLUMNS)
    act = inp.activity
    if cfg.derive_dormancy:
        act = act.withColumn("dormant_flag", is_dormant(F.col("days_since_activity"), cfg.dormancy_days))
    act = most_recent_account(act).select("customer_id", *ACTIVITY_COLUMNS)
    return (screened.join(vel, "customer_id", "left")
            .join(doc, "customer_id", "left")
            .join(act, "customer_id", "left"))


def scored(inp: Inputs, cfg: RiskConfig = RiskConfig(), **kw) -> DataFrame:
    return with_alerts(with_risk(signals(inp, cfg, **kw), cfg.weights, cfg.alerts), cfg.alerts)


def customer_360(inp: Inputs, run_ts: Column | str | None = None,
                 cfg: RiskConfig = RiskConfig(), **kw) -> DataFrame:
    """The 22 gold columns plus ``gold_timestamp``."""
    ts = (F.current_timestamp() if run_ts is None
          else F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts)
    return scored(inp, cfg, **kw).select(*GOLD_COLUMNS).withColumn("gold_timestamp", ts)
