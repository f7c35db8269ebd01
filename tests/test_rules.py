"""Rule boundaries and NULL handling on hand-made rows."""

import datetime as dt


from riskview.functions.masking import mask_dob_year, mask_email, mask_ssn
from riskview.operators import cleaning, screening
from riskview.operators.scoring import (velocity_profile, velocity_risk, with_alerts,
                                        with_risk)


def test_velocity_thresholds_are_strict(spark):
    rows = [(1, 10, 100.0), (2, 11, 100.0), (3, 20, 100.0), (4, 21, 100.0),
            (5, 1, 500000.0), (6, 1, 500000.01), (7, 1, 1000000.0), (8, 1, 1000000.01)]
    df = spark.createDataFrame(rows, "customer_id long, txn_count long, txn_total_amt double")
    got = dict(velocity_risk(df).select("customer_id", "velocity_risk").collect())
    assert got == {1: "LOW", 2: "MEDIUM", 3: "MEDIUM", 4: "HIGH",
                   5: "LOW", 6: "MEDIUM", 7: "MEDIUM", 8: "HIGH"}


def test_velocity_profile_counts_success_only_and_sums_to_cents(spark):
    rows = [(1, 1, "SUCCESS", 0.1, "Y"), (2, 1, "SUCCESS", 0.2, "N"),
            (3, 1, "FAILED", 99.0, "Y"), (4, 2, "PENDING", 5.0, "Y")]
    df = spark.createDataFrame(
        rows, "transaction_id long, customer_id long, status string, amount double, "
              "cross_border_flag string")
    got = velocity_profile(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.customer_id, r.txn_count, r.txn_total_amt, r.cross_border_count) == (1, 2, 0.3, 1)


def test_velocity_window_is_half_open(spark):
    ts = dt.datetime
    rows = [(1, 1, "SUCCESS", 1.0, "N", ts(2001, 7, 2)), (2, 1, "SUCCESS", 2.0, "N", ts(2001, 7, 2, 0, 0, 1)),
            (3, 1, "SUCCESS", 4.0, "N", ts(2001, 8, 1)), (4, 1, "SUCCESS", 8.0, "N", ts(2001, 8, 1, 0, 0, 1))]
    df = spark.createDataFrame(
        rows, "transaction_id long, customer_id long, status string, amount double, "
              "cross_border_flag string, txn_date timestamp")
    r = velocity_profile(df, window_days=30, as_of="2001-08-01").collect()[0]
    assert (r.txn_count, r.txn_total_amt) == (2, 6.0)


def _signals(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id long, velocity_risk string, doc_status string, dormant_flag string, "
              "pep_flag string, cross_border_count long, aml_flag boolean")


def test_risk_score_levels_and_null_signals(spark):
    rows = [(1, None, None, None, None, None, None),         # 0 LOW
            (2, "MEDIUM", None, None, None, None, None),     # 2 LOW
            (3, None, "EXPIRED", None, "N", None, None),     # 3 MEDIUM
            (4, "HIGH", "PENDING", None, "N", 0, False),     # 5 MEDIUM
            (5, None, "EXPIRED", None, "Y", 1, True),        # 6 HIGH
            (6, "HIGH", "EXPIRED", "Y", "Y", 2, True)]       # 11 HIGH
    out = {r.customer_id: (r.risk_score, r.kyc_risk_level)
           for r in with_risk(_signals(spark, rows)).collect()}
    assert out == {1: (0, "LOW"), 2: (2, "LOW"), 3: (3, "MEDIUM"), 4: (5, "MEDIUM"),
                   5: (6, "HIGH"), 6: (11, "HIGH")}


def test_alerts_never_null(spark):
    rows = [(1, None, None, None, None, None, None), (2, None, "EXPIRED", "Y", "Y", 1, True),
            (3, None, "EXPIRED", "N", "Y", 0, True), (4, None, None, None, "Y", 3, None)]
    out = {r.customer_id: (r.dormancy_alert, r.high_risk_profile)
           for r in with_alerts(_signals(spark, rows)).collect()}
    assert out == {1: (False, False), 2: (True, True), 3: (False, False), 4: (False, False)}


def test_masks(spark):
    df = spark.createDataFrame(
        [("123-45-6789", dt.date(1975, 3, 4), "alice@example.com"),
         (None, None, None), ("12", dt.date(2001, 1, 1), "no-at-sign")],
        "ssn string, dob date, email string")
    got = df.select(mask_ssn("ssn").alias("s"), mask_dob_year("dob").alias("d"),
                    mask_email("email").alias("e")).collect()
    assert [tuple(r) for r in got] == [("***-**-6789", "1975", "a***@example.com"),
                                       (None, None, None), ("***-**-", "2001", None)]


def test_mask_customer_pii_keeps_position(spark):
    df = spark.createDataFrame([(1, "123-45-6789", "x@y.z", dt.date(1990, 1, 1), "keep")],
                               "customer_id long, ssn string, email string, "
                               "date_of_birth date, other string")
    out = cleaning.mask_customer_pii(df)
    assert out.columns == df.columns
    assert tuple(out.first()) == (1, "***-**-6789", "x***@y.z", "1990", "keep")


def test_dedup_ties_break_on_id(spark):
    df = spark.createDataFrame(
        [(1, 10, dt.date(2020, 1, 1)), (1, 11, dt.date(2020, 1, 1)), (1, 9, dt.date(2019, 1, 1)),
         (2, 5, None), (2, 4, dt.date(2000, 1, 1))],
        "customer_id long, doc_id long, verification_date date")
    got = dict(cleaning.latest_per_customer(df).select("customer_id", "doc_id").collect())
    assert got == {1: 11, 2: 4}   # NULL dates sort last


def test_exact_screen_null_name_and_duplicates(spark):
    cust = spark.createDataFrame([(1, "A B"), (2, None), (3, "C"), (4, "A B")],
                                 "customer_id long, full_name string")
    wl = spark.createDataFrame([(1, "A B"), (2, "A B"), (3, None)],
                               "watchlist_id long, entity_name string")
    got = dict(screening.with_aml_flag(cust, wl).select("customer_id", "aml_flag").collect())
    assert got == {1: True, 2: False, 3: False, 4: True}


def test_screen_normalize_and_alias(spark):
    cust = spark.createDataFrame([(1, "  john   SMITH "), (2, "Jane Roe")],
                                 "customer_id long, full_name string")
    wl = spark.createDataFrame([(1, "John Smith", "J. Roe"), (2, "X", "jane roe")],
                               "watchlist_id long, entity_name string, alias string")
    got = dict(screening.with_aml_flag(cust, wl, include_alias=True, normalize=True)
               .select("customer_id", "aml_flag").collect())
    assert got == {1: True, 2: True}
    plain = dict(screening.with_aml_flag(cust, wl).select("customer_id", "aml_flag").collect())
    assert plain == {1: False, 2: False}


def test_velocity_fx_conversion(spark):
    import pytest

    from riskview.operators.scoring import unmatched_currencies
    txns = spark.createDataFrame(
        [(1, 1, "SUCCESS", 100.0, "N", "USD"), (2, 1, "SUCCESS", 10.0, "N", "GBP"),
         (3, 1, "SUCCESS", 7.0, "N", "XXX")],
        "transaction_id long, customer_id long, status string, amount double, "
        "cross_border_flag string, currency string")
    rates = spark.createDataFrame([("USD", 83.0), ("GBP", 105.0)], "currency string, rate double")
    r = velocity_profile(txns.filter("currency <> 'XXX'"), fx_rates=rates).first()
    assert (r.txn_count, r.txn_total_amt) == (2, 9350.0)
    with pytest.raises(Exception, match="no rate for currency XXX"):  # an amount is never lost
        velocity_profile(txns, fx_rates=rates).collect()
    assert [tuple(x) for x in unmatched_currencies(txns, rates).collect()] == [("XXX", 1)]


def test_money_is_summed_exactly_and_rounded_once(spark):
    from pyspark.sql import functions as F

    from riskview.operators.scoring import money_sum

    def total(*amounts, kind="double"):
        return spark.createDataFrame([(a,) for a in amounts], "a double").select(
            money_sum(F.col("a").cast(kind))).first()[0]
    assert total(*[0.004] * 1000) == 4.0
    assert (total(-0.125), total(0.125), total(0.1, 0.2)) == (-0.13, 0.13, 0.3)
    assert total(1.005, 1.005) == 2.01 and total(None) is None and total(None, 2.5) == 2.5
    assert total(float("nan"), 1.0) != total(float("nan"), 1.0)      # NaN stays NaN
    assert total(float("inf"), 1.0) == float("inf") and total(1e20, 1.0) == 1e20
    assert total(83.126 * 3, kind="decimal(20,6)") == 249.38


def test_score_follows_the_configured_markers(spark):
    from riskview.config import AlertRules, RiskWeights
    rows = [(1, None, None, "yes", "yes", None, None), (2, None, None, "Y", "Y", None, None)]
    rules = AlertRules(dormant_value="yes", pep_value="yes")
    got = {r.customer_id: r.risk_score for r in with_risk(_signals(spark, rows), RiskWeights(), rules).collect()}
    assert got == {1: 5, 2: 0}


def test_dormancy_can_be_derived_from_days(spark):
    from pyspark.sql import functions as F

    from riskview import fixtures as fx
    from riskview.config import RiskConfig
    from riskview.plans import catalog
    from riskview.plans import customer_360 as c360
    from tests.conftest import SF_SMALL
    inp = catalog.inputs(spark, SF_SMALL)
    flags = lambda cfg: c360.signals(inp, cfg).filter("dormant_flag = 'Y'").count()
    days = fx.activity(spark, SF_SMALL).filter(F.col("days_since_activity") > 100).count()
    assert flags(RiskConfig()) == 32 and flags(RiskConfig(derive_dormancy=True)) == 32
    assert flags(RiskConfig(derive_dormancy=True, dormancy_days=100)) == days


def test_fuzzy_screen_options(spark):
    cust = spark.createDataFrame([(1, "  JOHN smith "), (2, "a"), (3, "b")], "customer_id long, full_name string")
    wl = spark.createDataFrame([(1, "Jon Smith", "x"), (2, "zz", "john smyth"), (3, "c", None)],
                               "watchlist_id long, entity_name string, alias string")
    run = lambda **kw: sorted(map(tuple, screening.fuzzy_screen(cust, wl, 1, **kw).collect()))
    assert run() == [(2, "c", 1), (3, "c", 1)]
    assert run(normalize=True)[0] == (1, "jon smith", 1)
    assert run(normalize=True, include_alias=True, all_hits=True)[:2] == [(1, "john smyth", 1), (1, "jon smith", 1)]
    assert run(broadcast_max_rows=0) == run()


def test_schema_report_types_and_strict(spark):
    import pytest
    from riskview.operators.quality import SchemaContractError, schema_report
    t = {"a": spark.createDataFrame([(1, None)], "id long, name string")}
    rep = {r.column_name: r for r in schema_report(
        t, {"a": ["id", "name", "gone"]}, expected_types={"a": {"id": "int"}}).collect()}
    assert (rep["id"].present, rep["id"].actual_type) == (False, "bigint")
    assert (rep["name"].present, rep["name"].null_count, rep["gone"].null_count) == (True, 1, None)
    assert rep["id"].table_passed is False
    with pytest.raises(SchemaContractError, match="gone"):
        schema_report(t, {"a": ["id", "gone"]}, strict=True)
