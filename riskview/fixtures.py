"""Driver tables mapped onto the five source roles of the pipeline.

The test data is a TPC-H-like star, not customer-due-diligence files, so each
role is a deterministic view over it (customers from customer+nation,
transactions from orders, documents from orders, a watchlist from supplier,
account activity from customer+orders).  Every view is lazy and reads whole
tables, so the work of a query grows with the data.  The matching DuckDB text
for the oracles is in ``riskview.plans.oracle``.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskview.operators.scoring import is_dormant

# Reference date of the fixtures ("today" for activity and dormancy).
AS_OF = "2001-08-01"
# Run timestamps of the two simulated pipeline runs.
RUN = "2024-01-31 00:00:00"
RUN2 = "2024-02-29 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Its schema is inferred once per path and then passed
    explicitly, so later reads plan without a footer-inference job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


Role = Callable[[SparkSession, str], DataFrame]


def session_view(build: Role) -> Role:
    """Register a role once per session as a temporary view over ``sf_dir``;
    later calls are one catalog lookup instead of re-building and
    re-analysing the same plan.  The view stays lazy: every query still
    scans the whole tables, and using it twice in one plan is a self-join
    Spark resolves like any repeated view."""
    role = build.__name__

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"rv_{role}_{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"
        try:
            return spark.table(name)
        except AnalysisException:
            build(spark, sf_dir).createOrReplaceTempView(name)
            return spark.table(name)
    return get


def run_ts(value: str = RUN) -> Column:
    return F.lit(value).cast("timestamp")


def _s(c: Column) -> Column:
    return c.cast("string")


@session_view
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_onboarding role: one row per customer, with PII columns."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    email = (F.when(k % 19 == 0, F.lit(None).cast("string"))
             .when(k % 17 == 0, F.lit("no-at-sign"))
             .otherwise(F.concat(F.lit("user"), _s(k), F.lit("@mail"), _s(k % 3),
                                 F.lit(".example"))))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(
                k.alias("customer_id"),
                F.col("c_name").alias("full_name"),
                F.date_add(F.lit("1940-01-01").cast("date"),
                           (k % 20000).cast("int")).alias("date_of_birth"),
                F.concat(F.lpad(_s(k % 1000), 3, "0"), F.lit("-"),
                         F.lpad(_s(k % 100), 2, "0"), F.lit("-"),
                         F.lpad(_s(k % 10000), 4, "0")).alias("ssn"),
                email.alias("email"),
                F.when(k % 4 == 1, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("PH-"), _s(k))).alias("phone"),
                F.col("n_name").alias("country"),
                F.col("c_mktsegment").alias("customer_segment"),
                F.when(k % 5 == 0, "Y").otherwise("N").alias("pep_flag"),
                F.col("c_nationkey")))


@session_view
def beneficiary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the smallest supplier nation among its lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .groupBy("l_orderkey")
            .agg(F.min("s_nationkey").alias("beneficiary_nation")))


@session_view
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transaction_feed role: one row per order."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    b = beneficiary(spark, sf_dir)
    status = F.col("o_orderstatus")
    return (o.join(b, b.l_orderkey == o.o_orderkey, "left")
            .join(c, o.o_custkey == c.c_custkey)
            .select(
                F.col("o_orderkey").alias("transaction_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_orderdate").alias("txn_date"),
                F.col("o_totalprice").alias("amount"),
                F.col("o_orderpriority").alias("txn_type"),
                F.when(status == "F", "SUCCESS").when(status == "O", "PENDING")
                 .otherwise("FAILED").alias("status"),
                F.when(F.col("beneficiary_nation") != F.col("c_nationkey"), "Y")
                 .otherwise("N").alias("cross_border_flag")))


@session_view
def kyc_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kyc_documents role: several documents per customer."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    vdate = F.to_date(F.col("o_orderdate"))
    return o.select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("doc_type"),
        F.when(status == "F", "VERIFIED").when(status == "P", "PENDING")
         .otherwise("EXPIRED").alias("doc_status"),
        vdate.alias("verification_date"),
        F.date_add(vdate, 365).alias("expiry_date"))


@session_view
def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """watchlist_sanctions role: supplier names rewritten to collide."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("watchlist_id"),
        F.replace(F.col("s_name"), F.lit("Supplier"), F.lit("Customer"))
         .alias("entity_name"),
        F.when(F.col("s_suppkey") % 2 == 0, "OFAC").otherwise("UN").alias("list_type"),
        F.concat(F.lit("entity of nation "), _s(F.col("s_nationkey"))).alias("designation"))


@session_view
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """account_activity role: one account per customer that has orders."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    last = (o.groupBy("o_custkey")
            .agg(F.max("o_orderdate").alias("last_ts")))
    days = F.datediff(F.lit(AS_OF).cast("date"), F.to_date("last_ts"))
    bal = F.col("c_acctbal")
    return (c.join(last, c.c_custkey == last.o_custkey)
            .select(
                F.col("c_custkey").alias("account_id"),
                F.col("c_custkey").alias("customer_id"),
                bal.alias("balance"),
                F.when(bal >= 7000, "HIGH").when(bal >= 3000, "MID")
                 .otherwise("LOW").alias("balance_tier"),
                days.cast("long").alias("days_since_activity"),
                is_dormant(days).alias("dormant_flag")))


SCD2_INPUT_COLUMNS = ("customer_id", "full_name", "customer_segment", "country",
                      "phone", "pep_flag")


@session_view
def customers_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second customer batch: changed, unchanged, absent and new keys."""
    cu = customers(spark, sf_dir)
    k = F.col("customer_id")
    changed = (cu.filter(k % 10 != 7).select(
        k, "full_name",
        F.when(k % 10 == 0, "CHANGED").otherwise(F.col("customer_segment"))
         .alias("customer_segment"),
        F.when(k % 10 == 3, "NATION_X").otherwise(F.col("country")).alias("country"),
        F.when(k % 20 == 1, "PH-NEW").otherwise(F.col("phone")).alias("phone"),
        "pep_flag"))
    new = cu.filter(k % 50 == 0).select(
        (k + 1000000).alias("customer_id"), "full_name", "customer_segment",
        "country", "phone", "pep_flag")
    return changed.unionByName(new)


@session_view
def scd2_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(*SCD2_INPUT_COLUMNS)
