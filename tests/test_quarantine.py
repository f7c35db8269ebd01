"""Corrupt records and miscast values are kept, counted and judged."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskview.operators import quarantine
from riskview.operators.quality import SchemaContractError
from riskview.plans import pipeline
from riskview.schemas import ACCOUNT_ACTIVITY

RUN = "2024-01-31 00:00:00"


def test_values_counts_and_columns_read(spark, tmpdir_path):
    rows = [(1, "2024-01-01", "x", None), (2, "soon", "y", None), (None, None, None, "{broken"),
            (4, None, "z", None), (4, "", "z", None)]
    path = f"{tmpdir_path}/in"
    spark.createDataFrame(rows, "id long, day string, other string, bad string").write.parquet(path)
    out, seen, columns = quarantine.set_aside(spark.read.parquet(path), {"day": "date"}, "bad", ["id"], ["nowhere"])
    got = sorted(((r.column_name, r.value, r.key) for r in out.collect()), key=repr)
    assert got == [("bad", "{broken", "{}"), ("day", "", '{"id":4}'), ("day", "soon", '{"id":2}')]
    assert quarantine.tally(seen, columns) == [("bad", 5, 1), ("day", 5, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan.split("ReadSchema")[-1]  # a narrow scan
    quarantine.judge(quarantine.tally(seen, columns), 0.4, "t")
    with pytest.raises(quarantine.QuarantineError, match="t: day 2 of 5"):
        quarantine.judge(quarantine.tally(seen, columns), 0.3, "t")


def test_empty_input(spark, tmpdir_path):
    empty = spark.createDataFrame([], "id long, day string")
    out, seen, columns = quarantine.set_aside(empty, {"day": "date"}, None, ["id"])
    out.write.parquet(f"{tmpdir_path}/out")
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 0
    assert quarantine.tally(seen, columns) == [("day", 0, 0)]
    quarantine.judge(quarantine.tally(seen, columns), 0.0, "t")


def test_runs_and_stream_batches(spark, tmpdir_path):
    """A re-run replaces what it set aside, a stream batch adds its own, and
    rows with a miscast value stay in silver."""
    feed = spark.createDataFrame([], "transaction_id string, customer_id string, txn_date timestamp, amount double").schema
    lay = pipeline.Layout(landing=f"{tmpdir_path}/landing", root=f"{tmpdir_path}/lake",
                          formats={"transaction_feed": "ndjson", "account_activity": "parquet_stream"},
                          schemas={"transaction_feed": feed, "account_activity": ACCOUNT_ACTIVITY})
    lines = [json.dumps({"transaction_id": str(i), "customer_id": "C", "amount": 1.0}) for i in range(5)] + ["{oops"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{lay.landing}/transaction_feed")

    def accounts(*days):
        rows = [tuple({"account_id": f"{days}{i}", "customer_id": "C", "last_activity_date": d}.get(f.name)
                      for f in ACCOUNT_ACTIVITY.fields) for i, d in enumerate(days)]
        spark.createDataFrame(rows, ACCOUNT_ACTIVITY).write.mode("append").parquet(f"{lay.landing}/account_activity")

    def report():
        return {(r.table_name, r.column_name): (r.rows, r.good, r.bad) for r in pipeline.quarantine_report(spark, lay).collect()}

    accounts("2024-01-01", "never")
    for _ in range(2):  # the run again
        pipeline.run_tables(spark, lay, RUN)
        assert report() == {("transaction_feed", "_corrupt_record"): (6, 5, 1),
                            ("account_activity", "last_activity_date"): (2, 1, 1),
                            ("account_activity", "batch_hour"): (2, 2, 0)}
    accounts("2024-13-01")
    pipeline.run_tables(spark, lay, RUN)
    assert report()[("account_activity", "last_activity_date")] == (3, 1, 2)
    assert {(r.table_name, r.value) for r in pipeline.quarantined(spark, lay).collect()} == {
        ("transaction_feed", "{oops"), ("account_activity", "never"), ("account_activity", "2024-13-01")}
    store = lay.store(spark)
    assert store.read("silver", "account_activity").count() == 3 and store.read("silver", "transaction_feed").count() == 5
    with pytest.raises(quarantine.QuarantineError, match="_corrupt_record 1 of 6"):
        pipeline.silver_table(spark, replace(lay, most_bad=0.1), "transaction_feed", RUN)


def test_the_gate_checks_types(spark, tmpdir_path):
    lay = pipeline.Layout(landing=f"{tmpdir_path}/landing", root=f"{tmpdir_path}/lake")
    store = lay.store(spark)
    for name, columns in pipeline.SILVER_CONTRACTS.items():
        types = pipeline.silver_column_types(lay, name)
        store.publish(spark.createDataFrame([], ", ".join(f"{c} {types[c]}" for c in columns)), "silver", name)
    assert all(r.present for r in pipeline.silver_contract(spark, lay).collect())
    feed = store.read("silver", "transaction_feed")
    store.publish(feed.withColumn("amount", F.col("amount").cast("string")), "silver", "transaction_feed")
    with pytest.raises(SchemaContractError, match="transaction_feed: amount"):
        pipeline.silver_contract(spark, lay)
