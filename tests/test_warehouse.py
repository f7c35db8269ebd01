"""Surrogate keys and dimension builders."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskview.operators import warehouse


def test_dense_keys_equal_global_row_number(spark):
    df = spark.range(0, 300000, 7).select((F.col("id") * 3).alias("k"),
                                          (F.col("id") % 5).alias("v"))
    got = warehouse.dense_keys(df, "key", ["k", "v"])
    ref = df.withColumn("key", F.row_number().over(Window.orderBy("k", "v")))
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert got.count() == df.count()


def test_dense_keys_string_keys_follow_natural_order(spark):
    df = spark.createDataFrame([(f"C{i:05d}",) for i in range(499, -1, -1)], "cid string")
    got = warehouse.dense_keys(df.repartition(7), "key", ["cid"])
    assert sorted((r.key, r.cid) for r in got.collect()) == \
        [(i + 1, f"C{i:05d}") for i in range(500)]


def test_dense_keys_hot_natural_key_is_split(spark):
    """One customer holding a third of the versions: the numbering still
    equals the global row_number and the hot key spans several tasks."""
    hot = spark.range(0, 60000).select(F.lit(42).cast("long").alias("customer_id"),
                                       F.col("id").alias("version"))
    rest = spark.range(0, 120000).select((F.col("id") % 5000).alias("customer_id"),
                                         (F.col("id") + 10**6).alias("version"))
    df = hot.unionByName(rest)
    # keep partitions as small, relative to the data, as they are at scale
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    saved = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        got = warehouse.dense_keys(df, "key", ["customer_id", "version"])
        numbered = warehouse.number_rows(df, ["customer_id", "version"], "mid")
    finally:
        spark.conf.set(key, saved)
    ref = df.withColumn("key", F.row_number().over(
        Window.orderBy("customer_id", "version")))
    assert got.count() == 180000
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    hot_parts = (numbered.filter(F.col("customer_id") == 42)
                 .select(F.shiftright("mid", 33)).distinct().count())
    assert hot_parts > 1


def test_extend_keys_keeps_existing(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "customer_key long, customer_id long")
    new = spark.createDataFrame([(10,), (30,), (25,)], "customer_id long")
    got = dict((r.customer_id, r.customer_key) for r in
               warehouse.extend_keys(new, old, "customer_key", ["customer_id"],
                                     ["customer_id"]).collect())
    assert got == {10: 1, 25: 3, 30: 4}


def test_dim_date_columns(spark):
    src = spark.createDataFrame([("2024-02-28",), ("2024-03-01",)], "d string") \
        .select(F.to_date("d").alias("d"))
    rows = warehouse.dim_date(F.col("d"), src).orderBy("date_key").collect()
    assert [r.date_key for r in rows] == [20240228, 20240229, 20240301]
    assert (rows[1].quarter, rows[1].month_name, rows[2].day) == (1, "February", 1)


def test_star_rollup_broadcasts_sized_dimensions(spark):
    """All dimensions are broadcast once proven small; the fact is shuffled
    for the grouping only.  Beyond the bound the result is the same."""
    fact = spark.createDataFrame([(1, "HIGH", 10.0, 6, 20240131), (2, "LOW", 5.5, 1, 20240131)],
                                 "customer_id long, kyc_risk_level string, "
                                 "txn_total_amt double, risk_score int, date_key int")
    cust = spark.createDataFrame([(1, "A", "X", True), (2, "B", "Y", True), (2, "Z", "Y", False)],
                                 "customer_id long, customer_segment string, country string, is_current boolean")
    kyc = spark.createDataFrame([(1, "EXPIRED")], "customer_id long, doc_status string")
    days = spark.createDataFrame([(20240131, 2024, 1)], "date_key int, year int, month int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = warehouse.star_rollup(fact, cust, kyc, days, broadcast_max_rows=10)
        plan = small._jdf.queryExecution().executedPlan().toString()
        big = warehouse.star_rollup(fact, cust, kyc, days, broadcast_max_rows=0)
        rows = [sorted(map(str, d.collect())) for d in (small, big)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 3 and plan.count("Exchange hashpartitioning") == 1
    assert rows[0] == rows[1]
    assert sorted(map(tuple, small.collect())) == [("A", "X", "EXPIRED", 2024, 1, "HIGH", 1, 10.0, 6.0),
                                                   ("B", "Y", None, 2024, 1, "LOW", 1, 5.5, 1.0)]


def test_document_keys_are_stable(spark):
    docs = lambda *ids: spark.createDataFrame([(i, "V", "P", None) for i in ids],
                                              "customer_id string, doc_status string, doc_type string, expiry_date date")
    first = warehouse.dim_document_status(docs("B", "C"), "u")
    again = warehouse.dim_document_status(docs("A", "B", "C"), "u", first)
    assert {r.customer_id: r.kyc_key for r in again.collect()} == {"B": 1, "C": 2, "A": 3}


def test_dim_date_covers_the_fact(spark):
    src = spark.createDataFrame([("2024-01-01",)], "d string").select(F.to_date("d").alias("d"))
    fact = spark.createDataFrame([(20240103,)], "date_key int")
    got = warehouse.dim_date(F.col("d"), src, fact)
    assert [r.date_key for r in got.orderBy("date_key").collect()] == [20240101, 20240102, 20240103]


def test_dim_customer_reload_keeps_keys(spark):
    import datetime as dt
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    end = dt.datetime(9999, 12, 31)
    cols = "customer_id long, full_name string, country string, customer_segment string, " \
           "pep_flag string, effective_from timestamp, effective_to timestamp, is_current boolean"
    h1 = spark.createDataFrame([(5, "a", "X", "S", "N", t1, end, True),
                                (7, "b", "X", "S", "N", t1, end, True)], cols)
    d1 = warehouse.dim_customer(h1)
    h2 = spark.createDataFrame([(5, "a", "X", "S", "N", t1, t2, False),
                                (5, "a", "Y", "S", "N", t2, end, True),
                                (7, "b", "X", "S", "N", t1, end, True),
                                (3, "c", "X", "S", "N", t2, end, True)], cols)
    d2 = {(r.customer_id, r.effective_from): (r.customer_key, r.is_current)
          for r in warehouse.dim_customer(h2, d1).collect()}
    assert d2 == {(5, t1): (1, False), (7, t1): (2, True), (3, t2): (3, True), (5, t2): (4, True)}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.sets(st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
                         st.text("ab", max_size=3)), min_size=1, max_size=40),
       st.integers(1, 6), st.integers(0, 100))
def test_dense_keys_property(spark, rows, parts, base):
    """Any unique order (NULLs first, as in Spark's ascending sort), any input
    partitioning, any base: keys are base+1..base+n in global sort order."""
    df = spark.createDataFrame(sorted(rows, key=str), "k int, s string").repartition(parts)
    got = warehouse.dense_keys(df, "key", ["k", "s"], base=base)
    ref = df.withColumn("key", (F.row_number().over(Window.orderBy("k", "s")) + base)
                        .cast("long"))
    assert sorted(map(tuple, got.collect()), key=str) == \
        sorted(map(tuple, ref.select(*got.columns).collect()), key=str)


def test_a_key_that_left_is_never_given_again(spark, tmpdir_path):
    """C drops out, D comes: D is numbered behind C, and C returns to its key."""
    ledger = warehouse.KeyLedger(spark, f"{tmpdir_path}/keys", "kyc_key", ("customer_id",))

    def load(*ids):
        rows = spark.createDataFrame([(i,) for i in ids], "customer_id string")
        out = ledger.keyed(rows)
        return {r.customer_id: r.kyc_key for r in out.collect()}

    assert load("A", "B", "C") == {"A": 1, "B": 2, "C": 3}
    assert load("A", "B", "D") == {"A": 1, "B": 2, "D": 4}
    assert load("C", "E") == {"C": 3, "E": 5}
    assert load() == {}
    assert load("E", "D", "C", "B", "A", "0") == {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "0": 6}
    assert ledger.known().count() == 6


def test_a_ledger_starts_from_the_published_dimension(spark, tmpdir_path):
    old = spark.createDataFrame([("A", 4), ("B", 9)], "customer_id string, kyc_key long")
    ledger = warehouse.KeyLedger(spark, f"{tmpdir_path}/keys", "kyc_key", ("customer_id",))
    ledger.seed(old)
    ledger.seed(old.limit(0))  # only the first time
    rows = spark.createDataFrame([("B",), ("C",)], "customer_id string")
    assert {r.customer_id: r.kyc_key for r in ledger.keyed(rows).collect()} == {"B": 9, "C": 10}


def test_fact_keys_of_a_smaller_rerun_are_not_reused(spark, tmpdir_path):
    ledger = warehouse.KeyLedger(spark, f"{tmpdir_path}/keys", "risk_key", ("customer_id", "date_key"))

    def run(day, *ids):
        rows = spark.createDataFrame([(i, day) for i in ids], "customer_id long, date_key int")
        return {r.customer_id: r.risk_key for r in ledger.keyed(rows).collect()}

    assert run(20240131, 1, 2, 3) == {1: 1, 2: 2, 3: 3}
    assert run(20240131, 1) == {1: 1}
    assert run(20240201, 1, 2) == {1: 4, 2: 5}
    assert run(20240131, 1, 3) == {1: 1, 3: 3}
