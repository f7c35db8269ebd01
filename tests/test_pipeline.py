"""The whole layered pipeline, run twice over the landed fixture roles."""

import os

from pyspark.sql import functions as F

from riskview import fixtures as fx
from riskview.plans import catalog, pipeline
from tests.conftest import SF_SMALL


def test_run_all_twice_keeps_keys_and_adds_one_fact_day(spark, tmpdir_path):
    lay = catalog.land_fixtures(spark, SF_SMALL, tmpdir_path)
    pipeline.run_all(spark, lay, fx.RUN)
    store = lay.store(spark)
    n = fx.customers(spark, SF_SMALL).count()
    gold1 = sorted(map(str, store.read("gold", "customer_360")
                       .drop("gold_timestamp").collect()))
    dim1 = {(r.customer_id, r.effective_from): r.customer_key
            for r in store.read("warehouse", "dim_customer").collect()}
    assert sorted(dim1.values()) == list(range(1, n + 1))

    # the same files again a month later: a new bronze day, no SCD2 change
    pipeline.run_all(spark, lay, fx.RUN2)
    hist = store.read("silver", "customer_onboarding")
    assert hist.count() == n and hist.filter("is_current").count() == n
    dim2 = {(r.customer_id, r.effective_from): r.customer_key
            for r in store.read("warehouse", "dim_customer").collect()}
    assert dim2 == dim1
    fact = spark.read.parquet(f"{lay.root}/warehouse/fact_customer_risk")
    per_day = {r.date_key: r.n for r in fact.groupBy("date_key")
               .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_day == {20240131: n, 20240229: n}
    assert fact.select("risk_key").distinct().count() == 2 * n       # over all days
    # every fact row has its day, segment, country and document status
    assert pipeline.star(spark, lay).agg(F.sum("customers")).first()[0] == 2 * n
    assert pipeline.star(spark, lay).select("year", "month").distinct().count() == 2
    bronze_days = {r.ingest_day for r in spark.read.parquet(f"{lay.bronze}/transaction_feed")
                   .select("ingest_day").distinct().collect()}
    assert bronze_days == {31, 29}
    gold = store.read("gold", "customer_360")
    assert gold.count() == n and gold.select("customer_id").distinct().count() == n
    # unchanged sources (the activity stream has no new files): same view
    assert sorted(map(str, gold.drop("gold_timestamp").collect())) == gold1
    assert store.read("warehouse", "dim_date").count() > 0
    rep = {r.table_name: r for r in pipeline.layer_report(spark, lay, "silver").collect()}
    assert set(rep) == {*lay.formats, "TOTAL"} and all(r.error is None for r in rep.values())
    assert rep["customer_onboarding"].rows == n and rep["watchlist_sanctions"].rows > 0
    ext = pipeline.external_customer_360(spark, lay)
    assert len(ext.columns) == 19
    assert spark.sql("SELECT count(*) AS n, count_if(aml_flag) AS aml FROM ext_customer_360") \
        .first() == (n, gold.filter("aml_flag").count())
    assert store.read("warehouse", "dim_kyc_status").count() == n


def test_silver_dedup_tie_is_deterministic(spark):
    rows = [("C1", "2024-01-01", "A", "x"), ("C1", "2024-01-01", "B", "y"),
            ("C2", "2024-01-02", "A", "z")]
    df = spark.createDataFrame(rows, "customer_id string, record_date string, "
                                     "customer_segment string, phone string")
    for parts in (1, 2, 3):
        got = sorted(tuple(r) for r in pipeline.silver_dedup(
            df.repartition(parts), "customer_onboarding").collect())
        # same record_date: the other columns decide, descending
        assert got == [("C1", "2024-01-01", "B", "y"), ("C2", "2024-01-02", "A", "z")]


def test_rerun_of_the_same_run_ts_is_idempotent(spark, tmpdir_path):
    """Recovery from a lost job is a re-run of the same run: nothing doubles."""
    lay = catalog.land_fixtures(spark, SF_SMALL, tmpdir_path)
    store = lay.store(spark)

    root = spark.sparkContext.getCheckpointDir().split("file:", 1)[-1]
    numbered = {d for d in os.listdir(root) if d.startswith("riskview-numbered")}

    def snapshot():
        fact = spark.read.parquet(f"{lay.root}/warehouse/fact_customer_risk")
        return {
            "gold": sorted(map(str, store.read("gold", "customer_360")
                               .drop("gold_timestamp").collect())),
            "history": sorted(map(str, store.read("silver", "customer_onboarding").collect())),
            "dim": sorted(map(str, store.read("warehouse", "dim_customer").collect())),
            "fact": sorted(map(str, fact.collect())),
            "bronze": spark.read.parquet(f"{lay.bronze}/transaction_feed").count(),
        }

    pipeline.run_all(spark, lay, fx.RUN)
    first = snapshot()
    # the star query over the published fact and dimensions
    roll = pipeline.star(spark, lay)
    gold = store.read("gold", "customer_360")
    got = roll.agg(F.sum("customers"), F.round(F.sum("total_amount"), 2)).first()
    want = gold.agg(F.count(F.lit(1)), F.round(F.sum("txn_total_amt"), 2)).first()
    assert tuple(got) == tuple(want)
    pipeline.run_all(spark, lay, fx.RUN)
    assert snapshot() == first
    # numbered copies of the dimensions and the fact are gone once published
    assert {d for d in os.listdir(root) if d.startswith("riskview-numbered")} == numbered


def test_stream_silver_is_incremental_and_keeps_the_latest_row(spark, tmpdir_path):
    import datetime as dt

    from riskview.schemas import ACCOUNT_ACTIVITY
    t1, t2 = dt.datetime(2024, 1, 30, 10), dt.datetime(2024, 2, 28, 10)

    def rows(*accts):
        out = []
        for acct, bal, hour in accts:
            r = {f.name: None for f in ACCOUNT_ACTIVITY.fields}
            r.update(account_id=acct, customer_id="C" + acct, balance=bal, batch_hour=hour)
            out.append(tuple(r[f.name] for f in ACCOUNT_ACTIVITY.fields))
        return spark.createDataFrame(out, ACCOUNT_ACTIVITY)

    lay = pipeline.Layout(landing=f"{tmpdir_path}/landing", root=f"{tmpdir_path}/lake",
                          formats={"account_activity": "parquet_stream"},
                          schemas={"account_activity": ACCOUNT_ACTIVITY})
    src = f"{lay.landing}/account_activity"
    store = lay.store(spark)

    def run(ts):
        pipeline.run_bronze(spark, lay, ts)
        pipeline.run_silver(spark, lay, ts)
        return {r.account_id: r.balance for r in store.read("silver", "account_activity")
                .collect()}

    rows(("A1", 1.0, t1), ("A2", 2.0, t1), ("A3", 3.0, t1)).write.mode("append").parquet(src)
    assert run(fx.RUN) == {"A1": 1.0, "A2": 2.0, "A3": 3.0}
    rows(("A2", 20.0, t2), ("A4", 4.0, t2)).write.mode("append").parquet(src)
    want = {"A1": 1.0, "A2": 20.0, "A3": 3.0, "A4": 4.0}
    assert run(fx.RUN2) == want
    assert run(fx.RUN2) == want                   # re-run of the same day
    # a back-fill filed under an earlier day than the last run is consumed too
    rows(("A5", 5.0, t1),).write.mode("append").parquet(src)
    assert run("2024-02-10 00:00:00") == {**want, "A5": 5.0}


def test_bronze_read_lists_one_day_with_the_declared_schema(spark, tmpdir_path):
    lay = catalog.land_fixtures(spark, SF_SMALL, tmpdir_path)
    for run in (fx.RUN, fx.RUN2):
        pipeline.bronze_table(spark, lay, "transaction_feed", run)
    day = pipeline.read_bronze(spark, lay, "transaction_feed", fx.RUN2)
    assert day.inputFiles() and all("ingest_day=29" in f for f in day.inputFiles())
    assert {r.ingest_day for r in day.select("ingest_day").distinct().collect()} == {29}
    shape = lambda schema: [(f.name, f.dataType) for f in schema]
    assert shape(day.schema) == shape(pipeline.bronze_schema(lay, "transaction_feed"))


def test_rejects_and_contract_gate(spark, tmpdir_path):
    import pytest

    from riskview.operators.quality import SchemaContractError
    lay = catalog.land_fixtures(spark, SF_SMALL, tmpdir_path)
    cust = fx.customers(spark, SF_SMALL)
    cust.limit(1).withColumn("customer_id", F.lit(None).cast("long")).write.mode("append") \
        .option("header", True).csv(f"{lay.landing}/customer_onboarding")
    for run in (fx.RUN, fx.RUN2):
        pipeline.run_tables(spark, lay, run)
    store = lay.store(spark)
    assert store.read("silver", "customer_onboarding").count() == cust.count()
    assert store.read("silver", "customer_onboarding_rejects").count() == 1
    pipeline.run_gold(spark, lay, fx.RUN2)
    assert pipeline.gold_reports(spark, lay)["summary"].first().total == cust.count()
    store.publish(store.read("silver", "watchlist_sanctions").drop("list_type"), "silver", "watchlist_sanctions")
    with pytest.raises(SchemaContractError, match="list_type"):
        pipeline.run_gold(spark, lay, fx.RUN2)


def test_documents_may_be_partitioned_otherwise(spark, tmpdir_path):
    from dataclasses import replace
    lay = replace(catalog.land_fixtures(spark, SF_SMALL, tmpdir_path), silver_partitions={"kyc_documents": ("doc_status",)})
    for step in (pipeline.bronze_table, pipeline.silver_table):
        step(spark, lay, "kyc_documents", fx.RUN)
    assert any(d.startswith("doc_status=") for d in os.listdir(f"{lay.root}/silver/kyc_documents/version=0000000001"))


def test_changed_customer_extract_flows_into_history(spark, tmpdir_path):
    """A second customer extract with changed, absent and new customers goes
    landing -> bronze -> masked, deduplicated SCD2 history (FIXTURES counts:
    38 changed, 3 new, 15 absent of 150)."""
    lay = catalog.land_fixtures(spark, SF_SMALL, tmpdir_path)
    pipeline.run_tables(spark, lay, fx.RUN)
    schema = lay.schemas["customer_onboarding"]
    v2 = fx.customers_v2(spark, SF_SMALL)
    v2.select(*[(F.col(f.name) if f.name in v2.columns else F.lit(None)).cast(f.dataType)
                .alias(f.name) for f in schema.fields]) \
        .write.mode("overwrite").option("header", True) \
        .csv(f"{lay.landing}/customer_onboarding")
    pipeline.run_tables(spark, lay, fx.RUN2)
    hist = lay.store(spark).read("silver", "customer_onboarding")
    assert hist.count() == 191
    assert hist.filter("is_current").count() == 153
    assert hist.filter("NOT is_current").count() == 38
    assert hist.filter("is_current").groupBy("customer_id").count().filter("count > 1") \
        .count() == 0
    changed = hist.filter("is_current AND customer_id % 10 = 0 AND customer_id < 1000000")
    assert {r.customer_segment for r in changed.select("customer_segment").collect()} == \
        {"CHANGED"}
