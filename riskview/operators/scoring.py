"""Transaction velocity, risk score, risk level and alert flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.config import AlertRules, RiskWeights, VelocityRules
from riskview.operators.joins import broadcast_if_small


def money_sum(amount: Column) -> Column:
    """Exact sum of amounts, rounded once to cents (half away from zero), as
    DOUBLE.

    Amounts are added as decimals of ten places, which is exact and does not
    depend on the order of the rows.  A group with an amount that no such
    decimal holds (NaN, infinity, 1e18 and more) is added in doubles, so it
    shows in the result instead of being lost.
    """
    exact = amount.try_cast("decimal(28,10)")
    wide = F.coalesce(F.bool_or(amount.isNotNull() & exact.isNull()), F.lit(False))
    return (F.when(wide, F.round(F.sum(amount.cast("double")), 2))
            .otherwise(F.round(F.sum(exact), 2).cast("double")))


def unmatched_currencies(txns: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Currencies without a rate, with the number of transactions of each."""
    return (txns.groupBy("currency").agg(F.count(F.lit(1)).alias("transactions"))
            .join(fx_rates.select("currency"), "currency", "left_anti"))


def velocity_profile(txns: DataFrame, rules: VelocityRules = VelocityRules(),
                     window_days: int | None = None,
                     as_of: str | Column | None = None,
                     fx_rates: DataFrame | None = None) -> DataFrame:
    """Per customer over successful transactions: count, total, cross-border.

    ``window_days`` restricts to ``(as_of - window_days, as_of]`` (the
    stated 30-day intent); by default every successful transaction counts.
    ``fx_rates(currency, rate)`` converts amounts to one currency first; a
    currency without a rate raises (``unmatched_currencies`` lists them).  By
    default amounts are summed as given.  The rate table is bounded by the number of currencies
    and is broadcast after a size check.
    The status filter sits on the scan (pushed to Parquet) and the grouping
    is partial/final, so a hot customer costs one partial row per task.
    """
    t = txns.filter(F.col("status") == rules.status)
    if window_days is not None:
        # Bounds take the column's own type so the range reaches the scan
        # as a pushed filter instead of a cast per row.
        ts_type = txns.schema["txn_date"].dataType
        end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast(ts_type)
        start = (end - F.make_dt_interval(F.lit(window_days))).cast(ts_type)
        ts = F.col("txn_date")
        t = t.filter((ts > start) & (ts <= end))
    if fx_rates is not None:
        rates = broadcast_if_small(fx_rates.select(
            "currency", F.col("rate").cast("double").alias("__rv_rate")), 10_000)
        no_rate = F.raise_error(F.concat(F.lit("no rate for currency "),
                                         F.coalesce("currency", F.lit("NULL")))).cast("double")
        t = (t.join(rates, "currency", "left")
             .withColumn("amount", F.when(F.col("amount").isNull(), None).otherwise(
                 F.col("amount") * F.coalesce("__rv_rate", no_rate))))
    return t.groupBy("customer_id").agg(
        F.count("transaction_id").alias("txn_count"),
        money_sum(F.col("amount")).alias("txn_total_amt"),
        F.count_if(F.col("cross_border_flag") == rules.cross_border_value)
         .alias("cross_border_count"))


def velocity_label(count: Column, total: Column,
                   rules: VelocityRules = VelocityRules()) -> Column:
    return (F.when((count > rules.high_count) | (total > rules.high_amount), "HIGH")
            .when((count > rules.medium_count) | (total > rules.medium_amount), "MEDIUM")
            .otherwise("LOW"))


def velocity_risk(profile: DataFrame, rules: VelocityRules = VelocityRules()) -> DataFrame:
    return profile.withColumn(
        "velocity_risk",
        velocity_label(F.col("txn_count"), F.col("txn_total_amt"), rules))


def _weighted(c: Column, table: tuple[tuple[str, int], ...]) -> Column:
    expr = None
    for value, w in table:
        expr = (F.when(c == value, F.lit(w)) if expr is None
                else expr.when(c == value, F.lit(w)))
    return expr.otherwise(F.lit(0)) if expr is not None else F.lit(0)


def risk_score_expr(w: RiskWeights = RiskWeights(), a: AlertRules = AlertRules()) -> Column:
    """Weighted sum of the four signals; a NULL signal adds 0."""
    return (_weighted(F.col("velocity_risk"), w.velocity)
            + _weighted(F.col("doc_status"), w.doc_status)
            + F.when(F.col("dormant_flag") == a.dormant_value, F.lit(w.dormant)).otherwise(F.lit(0))
            + F.when(F.col("pep_flag") == a.pep_value, F.lit(w.pep)).otherwise(F.lit(0)))


def risk_level_expr(score: Column, w: RiskWeights = RiskWeights()) -> Column:
    return (F.when(score >= w.high_level, "HIGH")
            .when(score >= w.medium_level, "MEDIUM").otherwise("LOW"))


def with_risk(df: DataFrame, w: RiskWeights = RiskWeights(),
              a: AlertRules = AlertRules()) -> DataFrame:
    df = df.withColumn("risk_score", risk_score_expr(w, a))
    return df.withColumn("kyc_risk_level", risk_level_expr(F.col("risk_score"), w))


def dormancy_alert_expr(a: AlertRules = AlertRules()) -> Column:
    return F.coalesce((F.col("dormant_flag") == a.dormant_value)
                      & (F.col("doc_status") == a.expired_status), F.lit(False))


def high_risk_profile_expr(a: AlertRules = AlertRules()) -> Column:
    return F.coalesce((F.col("pep_flag") == a.pep_value)
                      & (F.col("cross_border_count") > 0)
                      & F.col("aml_flag"), F.lit(False))


def with_alerts(df: DataFrame, a: AlertRules = AlertRules()) -> DataFrame:
    return df.withColumns({"dormancy_alert": dormancy_alert_expr(a),
                           "high_risk_profile": high_risk_profile_expr(a)})


def is_dormant(days: Column, threshold_days: int = 365) -> Column:
    """Dormancy flag derived from the days since the last activity."""
    return F.when(days > threshold_days, "Y").otherwise("N")
