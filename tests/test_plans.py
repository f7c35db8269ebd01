"""Physical plan shape: pushdown, partial top-1, no cross/nested-loop joins."""

from riskview import fixtures as fx
from riskview.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_anywhere(spark):
    for name in ("customer_360", "fuzzy_screen", "watchlist_screen", "scd2_apply_all",
                 "dim_customer", "star_rollup", "fact_customer_risk"):
        p = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_dedup_uses_partial_window_group_limit(spark):
    p = _plan(catalog.QUERIES["dedup_lineitem"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_status_filter_reaches_scan(spark, tmpdir_path):
    """On a stored status column the predicate is a Parquet pushed filter."""
    from riskview.operators.scoring import velocity_profile
    txns = spark.createDataFrame(
        [(1, 1, "SUCCESS", 1.0, "Y"), (2, 1, "FAILED", 2.0, "N")],
        "transaction_id long, customer_id long, status string, amount double, "
        "cross_border_flag string")
    txns.write.parquet(f"{tmpdir_path}/t")
    p = _plan(velocity_profile(spark.read.parquet(f"{tmpdir_path}/t")))
    assert "EqualTo(status,SUCCESS)" in p


def test_fixture_status_filter_runs_before_any_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(catalog.QUERIES["velocity_profile"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = p.splitlines()
    i = next(k for k, ln in enumerate(lines) if "o_orderstatus" in ln and "Filter" in ln)
    below = [ln for ln in lines[i + 1:i + 3] if "ColumnarToRow" not in ln]
    assert "FileScan parquet" in below[0]


def test_projection_is_pruned(spark):
    df = catalog.QUERIES["velocity_profile"](spark, SF_SMALL)
    p = _plan(df)
    assert "o_orderpriority" not in p and "l_extendedprice" not in p


def test_watchlist_never_collected(spark):
    # the screen is a join: the plan, not the driver, carries the names
    p = _plan(catalog.QUERIES["watchlist_screen"](spark, SF_SMALL))
    assert "Join" in p


def test_dense_keys_single_partition_step_sees_only_counts(spark):
    from pyspark.sql import functions as F

    from riskview.operators import warehouse
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), "id")
        p = _plan(warehouse.dense_keys(df, "key", ["k", "id"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = p.splitlines()
    singles = [i for i, ln in enumerate(lines) if "SinglePartition" in ln]
    assert singles, p
    for i in singles:       # the operator right below is the count aggregate
        below = next(ln for ln in lines[i + 1:] if "InputAdapter" not in ln
                     and "WholeStageCodegen" not in ln)
        assert "HashAggregate" in below, p
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_small_scd2_batch_leaves_current_table_unshuffled(spark):
    from riskview.operators import scd2
    from tests.test_plans import _plan as plan
    first = scd2.scd2_initial(fx.scd2_batch1(spark, SF_SMALL), fx.RUN)
    batch = fx.customers_v2(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(scd2.scd2_apply(first, batch, ["customer_id"], catalog.TRACKED,
                                     fx.RUN2, broadcast_max_rows=1_000_000))
        big = plan(scd2.scd2_apply(first, batch, ["customer_id"], catalog.TRACKED,
                                   fx.RUN2, broadcast_max_rows=10))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in small and "LeftSemi" in small and "BroadcastHashJoin" in small
    assert "LeftAnti" not in big and "FullOuter" in big
