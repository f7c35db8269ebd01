"""A key holding a third of all rows: the map side reduces it before the
shuffle, so it ships at most one row per map task."""

from pyspark.sql import functions as F

from riskview.operators.cleaning import dedup_latest
from riskview.operators.scoring import velocity_profile

MAP_TASKS = 8


def _shuffle_records_written(df) -> int:
    """Sum of ``shuffleRecordsWritten`` over the executed plan's exchanges."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    stack, total = [plan.finalPhysicalPlan()], 0
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "ShuffleQueryStageExec":
            node = node.plan()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            m = node.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                total += m.get().value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_hot_key_dedup_ships_one_row_per_map_task(spark):
    n = 90_000
    df = spark.range(0, n, 1, MAP_TASKS).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"))
    out = dedup_latest(df, ["k"], ["ts"])
    distinct = n - n // 3 + 1
    assert out.count() == distinct
    assert out.filter("k = -1").first().ts == n - 3       # latest of the hot key
    assert _shuffle_records_written(out) <= distinct + MAP_TASKS


def test_hot_customer_velocity_is_pre_aggregated(spark):
    n = 90_000
    txns = spark.range(0, n, 1, MAP_TASKS).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
         .alias("customer_id"),
        F.lit("SUCCESS").alias("status"), F.lit(1.25).alias("amount"),
        F.when(F.col("id") % 2 == 0, "Y").otherwise("N").alias("cross_border_flag"))
    prof = velocity_profile(txns)
    hot = prof.filter("customer_id = 7").first()
    want = txns.filter("customer_id = 7").count()
    assert hot.txn_count == want and hot.txn_total_amt == want * 1.25
    assert _shuffle_records_written(prof) <= 1000 * MAP_TASKS


def test_hot_customer_name_is_screened_map_side(spark):
    from riskview.operators.screening import with_aml_flag
    n = 90_000
    customers = spark.range(0, n, 1, MAP_TASKS).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("JOHN DOE"))
         .otherwise(F.concat(F.lit("name-"), F.col("id").cast("string"))).alias("full_name"))
    watchlist = spark.createDataFrame([("JOHN DOE",), ("name-4",), ("nobody",)],
                                      "entity_name string")
    flagged = with_aml_flag(customers, watchlist)
    hits = flagged.filter("aml_flag").count()
    assert hits == n // 3 + 1                              # every hot row, plus name-4
    assert flagged.count() == n
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    # only the distinct listed names are shuffled, never the customer rows
    assert _shuffle_records_written(flagged) <= 3 * MAP_TASKS
