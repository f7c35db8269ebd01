"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs a library operator over the fixture roles derived from the
driver's tables (``riskview.fixtures``), over whole tables.  The matching
DuckDB oracle of every name is in ``riskview.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskview import fixtures as fx
from riskview.config import RiskConfig
from riskview.functions import masking
from riskview.functions.metadata import with_ingest_metadata, with_layer_metadata
from riskview.operators import (cleaning, quality, reports, scd2, screening, scoring,
                                 warehouse)
from riskview.plans import customer_360 as c360
from riskview.plans import pipeline
from riskview.schemas import EXTERNAL_CUSTOMER_360, SILVER_CONTRACTS, SOURCES
from riskview.session import scratch_path
from riskview.sources import readers
from riskview.sources.store import TableStore, write_partitioned
from riskview.streaming.ingest import (BATCH, INGEST_PARTITIONS, ingest_files,
                                       ingest_first_seen)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CFG = RiskConfig()
TRACKED = list(CFG.scd2.tracked)
KEYS = list(CFG.scd2.keys)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --------------------------------------------------------------------- inputs

def inputs(spark: SparkSession, sf: str) -> c360.Inputs:
    return c360.Inputs(
        customers=scd2.scd2_initial(fx.customers(spark, sf), fx.RUN),
        transactions=fx.transactions(spark, sf),
        documents=fx.kyc_documents(spark, sf),
        watchlist=fx.watchlist(spark, sf),
        activity=fx.activity(spark, sf))


def _scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    first = scd2.scd2_initial(fx.scd2_batch1(spark, sf), fx.RUN)
    return scd2.scd2_apply(first, fx.customers_v2(spark, sf), KEYS, TRACKED, fx.RUN2)


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return c360.customer_360(inputs(spark, sf), fx.RUN, CFG)


# ------------------------------------------------------------------- metadata

@query
def ingest_metadata(spark, sf):
    return with_ingest_metadata(fx.table(spark, sf, "customer"), "batch",
                                run_ts=fx.RUN)


@query
def silver_metadata(spark, sf):
    return with_layer_metadata(fx.transactions(spark, sf), "silver", fx.RUN)


# -------------------------------------------------------------------- masking

def _masked(spark, sf, name, fn):
    return fx.customers(spark, sf).select("customer_id", fn(F.col(name)).alias(name))


@query
def mask_ssn(spark, sf):
    return _masked(spark, sf, "ssn", masking.mask_ssn)


@query
def mask_dob_year(spark, sf):
    return _masked(spark, sf, "date_of_birth", masking.mask_dob_year)


@query
def mask_email(spark, sf):
    return _masked(spark, sf, "email", masking.mask_email)


@query
def mask_customer_pii(spark, sf):
    return cleaning.mask_customer_pii(fx.customers(spark, sf))


# ---------------------------------------------------------------------- dedup

@query
def dedup_latest(spark, sf):
    return cleaning.dedup_latest(fx.kyc_documents(spark, sf), ["customer_id"],
                                 ["verification_date", "doc_id"])


@query
def latest_document_per_customer(spark, sf):
    return (cleaning.latest_per_customer(fx.kyc_documents(spark, sf))
            .select("customer_id", "doc_status", "expiry_date"))


LINEITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                  "l_linestatus")


@query
def dedup_lineitem(spark, sf):
    return cleaning.dedup_latest(fx.table(spark, sf, "lineitem"),
                                 ["l_orderkey", "l_linenumber"], list(LINEITEM_ORDER))


# ----------------------------------------------------------------------- SCD2

@query
def scd2_first_load(spark, sf):
    return scd2.scd2_initial(fx.scd2_batch1(spark, sf), fx.RUN)


@query
def scd2_changed_keys(spark, sf):
    first = scd2.scd2_initial(fx.scd2_batch1(spark, sf), fx.RUN)
    return scd2.scd2_changed_keys(first, fx.customers_v2(spark, sf), KEYS, TRACKED)


@query
def scd2_apply_all(spark, sf):
    return _scd2_history(spark, sf)


@query
def scd2_current(spark, sf):
    return scd2.current_rows(_scd2_history(spark, sf))


@query
def scd2_history(spark, sf):
    return scd2.expired_rows(_scd2_history(spark, sf))


@query
def scd2_summary(spark, sf):
    return scd2.scd2_summary(_scd2_history(spark, sf))


# ------------------------------------------------------------------ screening

@query
def watchlist_names(spark, sf):
    return screening.watchlist_names(fx.watchlist(spark, sf))


@query
def watchlist_screen(spark, sf):
    return screening.watchlist_screen(fx.customers(spark, sf), fx.watchlist(spark, sf))


@query
def screen_summary(spark, sf):
    return reports.screen_summary(
        screening.watchlist_screen(fx.customers(spark, sf), fx.watchlist(spark, sf)))


@query
def fuzzy_screen(spark, sf):
    return screening.fuzzy_screen(fx.customers(spark, sf), fx.watchlist(spark, sf), 1)


@query
def fuzzy_screen_all_hits(spark, sf):
    return screening.fuzzy_screen(fx.customers(spark, sf), fx.watchlist(spark, sf), 1,
                                  all_hits=True)


# ------------------------------------------------------------------- velocity

@query
def velocity_profile(spark, sf):
    return scoring.velocity_profile(fx.transactions(spark, sf), CFG.velocity)


@query
def velocity_profile_30d(spark, sf):
    return scoring.velocity_profile(fx.transactions(spark, sf), CFG.velocity,
                                    window_days=30, as_of=fx.AS_OF)


@query
def velocity_risk(spark, sf):
    return scoring.velocity_risk(velocity_profile(spark, sf), CFG.velocity)


@query
def velocity_distribution(spark, sf):
    return velocity_risk(spark, sf).groupBy("velocity_risk").agg(
        F.count(F.lit(1)).alias("count"))


# -------------------------------------------------------------------- scoring

@query
def customer_signals(spark, sf):
    return c360.signals(inputs(spark, sf), CFG)


def _scored_col(spark, sf, name):
    return c360.scored(inputs(spark, sf), CFG).select("customer_id", name)


@query
def risk_score(spark, sf):
    return _scored_col(spark, sf, "risk_score")


@query
def risk_level(spark, sf):
    return _scored_col(spark, sf, "kyc_risk_level")


@query
def dormancy_alert(spark, sf):
    return _scored_col(spark, sf, "dormancy_alert")


@query
def high_risk_profile(spark, sf):
    return _scored_col(spark, sf, "high_risk_profile")


# ----------------------------------------------------------------------- gold

@query
def customer_360(spark, sf):
    return _gold(spark, sf)


@query
def external_view_customer_360(spark, sf):
    return readers.project_to(_gold(spark, sf), EXTERNAL_CUSTOMER_360)


@query
def risk_distribution(spark, sf):
    return reports.risk_distribution(_gold(spark, sf))


@query
def gold_summary(spark, sf):
    return reports.gold_summary(_gold(spark, sf))


@query
def alert_list(spark, sf):
    return reports.alert_list(_gold(spark, sf))


@query
def preview_top_n(spark, sf):
    return reports.preview(_gold(spark, sf))


# ------------------------------------------------------------------ warehouse

@query
def dim_customer(spark, sf):
    return warehouse.dim_customer(_scd2_history(spark, sf))


@query
def dim_document_status(spark, sf):
    docs = cleaning.latest_per_customer(fx.kyc_documents(spark, sf))
    return warehouse.dim_document_status(docs, default_verifier="unknown")


@query
def dim_date(spark, sf):
    return warehouse.dim_date(F.col("o_orderdate"), fx.table(spark, sf, "orders"))


def _fact(spark, sf):
    return warehouse.fact_customer_risk(_gold(spark, sf), fx.run_ts(fx.RUN))


@query
def fact_customer_risk(spark, sf):
    return _fact(spark, sf)


def _published(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back, as a published table is."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@query
def fact_two_runs(spark, sf):
    """Two run days, then the second day again: keys stay and stay unique."""
    path = scratch_path(spark, "fact")
    gold = _published(_gold(spark, sf), "gold")
    for run in (fx.RUN, fx.RUN2, fx.RUN2):
        known = spark.read.parquet(path) if run != fx.RUN else None
        write_partitioned(warehouse.fact_customer_risk(gold, fx.run_ts(run), known), path, ["date_key"])
    return spark.read.parquet(path)


@query
def dim_customer_reload(spark, sf):
    """The dimension after a second run: old keys kept, new ones behind."""
    first = scd2.scd2_initial(fx.scd2_batch1(spark, sf), fx.RUN)
    known = _published(warehouse.dim_customer(first), "dim")
    known = _published(warehouse.dim_customer(_scd2_history(spark, sf), known), "dim")
    return warehouse.dim_customer(_scd2_history(spark, sf), known)  # the reload again


@query
def dim_document_status_reload(spark, sf):
    """First the documents of customers with even ids, then all of them."""
    docs = cleaning.latest_per_customer(fx.kyc_documents(spark, sf))
    first = warehouse.dim_document_status(docs.filter("customer_id % 2 = 0"), "unknown")
    return warehouse.dim_document_status(docs, "unknown", _published(first, "dim-kyc"))


_STARS: dict[tuple[str, str], list[DataFrame]] = {}


def _star(spark, sf) -> list[DataFrame]:
    """The published star of this session: fact, customers, documents, days."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STARS:
        fact = _published(warehouse.fact_customer_risk(_gold(spark, sf), fx.run_ts(fx.RUN)), "fact")
        docs = cleaning.latest_per_customer(fx.kyc_documents(spark, sf))
        _STARS[key] = [fact, _published(warehouse.dim_customer(_scd2_history(spark, sf)), "dim-customer"),
                       _published(warehouse.dim_document_status(docs, "unknown"), "dim-kyc"),
                       _published(warehouse.dim_date(F.col("txn_date"), fx.transactions(spark, sf), fact), "dim-date")]
    return _STARS[key]


@query
def star_rollup(spark, sf):
    return warehouse.star_rollup(*_star(spark, sf), broadcast_max_rows=1_000_000)


# -------------------------------------------------------------------- quality

@query
def layer_row_counts(spark, sf):
    return quality.layer_row_counts({t: fx.table(spark, sf, t) for t in fx.TABLES})


@query
def layer_row_counts_total(spark, sf):
    return quality.layer_row_counts({t: fx.table(spark, sf, t) for t in fx.TABLES}, total="TOTAL")


def silver_tables(spark, sf) -> dict[str, DataFrame]:
    """The five silver-shaped tables built from the fixture roles."""
    return {
        "customer_onboarding": scd2.scd2_initial(
            cleaning.mask_customer_pii(fx.customers(spark, sf)), fx.RUN),
        "transaction_feed": fx.transactions(spark, sf),
        "kyc_documents": cleaning.latest_per_customer(fx.kyc_documents(spark, sf)),
        "watchlist_sanctions": fx.watchlist(spark, sf),
        "account_activity": fx.activity(spark, sf),
    }


@query
def schema_report(spark, sf):
    return quality.schema_report(silver_tables(spark, sf), SILVER_CONTRACTS)


# ------------------------------------------------------- sources, sinks, stream
# These write into the shared scratch folder (under spark.checkpoint.dir),
# then return the lazily read-back result.

@query
def bronze_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze-orders")
    df = with_ingest_metadata(fx.table(spark, sf, "orders"), "batch", run_ts=fx.RUN)
    write_partitioned(df, path, INGEST_PARTITIONS)
    return spark.read.parquet(path)


@query
def source_csv_customers(spark, sf):
    cust = fx.customers(spark, sf)
    path = scratch_path(spark, "landing-customers-csv")
    cust.write.option("header", True).csv(path)
    return readers.read_csv(spark, path, cust.schema)


@query
def source_ndjson_transactions(spark, sf):
    txns = fx.transactions(spark, sf)
    path = scratch_path(spark, "landing-transactions-json")
    txns.write.json(path)
    return readers.read_ndjson(spark, path, txns.schema)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """Land ``df`` as files that each hold one JSON array of at most
    ``rows_per_file`` objects (the documents feed's format).  A chunk is a run
    of rows inside one input partition, so no group exceeds the bound and
    the work spreads over all partitions."""
    mid = F.monotonically_increasing_id()
    chunk = F.concat_ws("-", F.shiftright(mid, 33).cast("string"),
                        F.floor(mid.bitwiseAND(F.lit((1 << 33) - 1)) / rows_per_file)
                        .cast("string"))
    rows = df.select(chunk.alias("chunk"), F.to_json(F.struct(*df.columns)).alias("j"))
    arrays = rows.groupBy("chunk").agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list("j")), F.lit("]"))
        .alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query
def source_nested_landing(spark, sf):
    """Files in plain and dated subfolders, batch and stream alike."""
    txns = fx.transactions(spark, sf)
    root = scratch_path(spark, "nested")
    txns.filter("transaction_id % 2 = 0").write.json(f"{root}/landing/2024-01-30")
    txns.filter("transaction_id % 2 = 1").write.json(f"{root}/landing/2024-01-31/late")
    ingest_files(spark, f"{root}/landing", txns.schema, f"{root}/bronze", f"{root}/_checkpoint",
                 "stream", run_ts=fx.RUN, fmt="json")
    streamed = spark.read.parquet(f"{root}/bronze").select(*txns.columns)
    batch = readers.read_ndjson(spark, f"{root}/landing", txns.schema)
    return batch.intersectAll(streamed)


@query
def source_corrupt_records(spark, sf):
    """Broken lines are kept in bronze and counted; good ones all arrive."""
    txns = fx.transactions(spark, sf)
    root = scratch_path(spark, "corrupt")
    lay = pipeline.Layout(landing=f"{root}/landing", root=root, formats={"transaction_feed": "ndjson"},
                          schemas={"transaction_feed": txns.schema})
    broken = spark.createDataFrame([('{"transaction_id": 1, "customer_id":',), ("not json",)], "value string")
    (txns.select(F.to_json(F.struct(*txns.columns)).alias("value")).union(broken)
     .write.text(f"{lay.landing}/transaction_feed"))
    pipeline.run_bronze(spark, lay, fx.RUN)
    return pipeline.corrupt_records(spark, lay, fx.RUN)


@query
def silver_quarantine(spark, sf):
    """Feeds with broken records (one transaction in seven is cut off) and
    account rows whose dates and times are no such values, through bronze and
    silver: good and bad values by column."""
    root = scratch_path(spark, "quarantine")
    txns = fx.transactions(spark, sf)
    activity = fx.activity(spark, sf).withColumns({
        "last_activity_date": F.when(F.col("customer_id") % 7 == 3, "unknown").otherwise("2001-07-31"),
        "batch_hour": F.when(F.col("customer_id") % 11 == 5, "").otherwise("2024-01-30T10:00:00")})
    lay = pipeline.Layout(landing=f"{root}/landing", root=root,
                          formats={"transaction_feed": "ndjson", "account_activity": "parquet_stream"},
                          schemas={"transaction_feed": txns.schema, "account_activity": activity.schema})
    line = F.to_json(F.struct(*txns.columns))
    txns.select(F.when(F.col("transaction_id") % 7 == 3, F.substring(line, 1, 12)).otherwise(line).alias("value")) \
        .write.text(f"{lay.landing}/transaction_feed")
    activity.write.parquet(f"{lay.landing}/account_activity")
    pipeline.run_tables(spark, lay, fx.RUN)
    return pipeline.quarantine_report(spark, lay)


@query
def source_json_array_documents(spark, sf):
    docs = fx.kyc_documents(spark, sf)
    path = scratch_path(spark, "landing-documents-json-array")
    write_json_arrays(docs, path, rows_per_file=5_000)
    return readers.read_json_array(spark, path, docs.schema)


@query
def stream_ingest_events(spark, sf):
    """Events landed as several files, ingested by one catch-up stream run."""
    ev = fx.table(spark, sf, "events")
    root = scratch_path(spark, "stream-events")
    ev.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{root}/landing")
    ingest_files(spark, f"{root}/landing", ev.schema, f"{root}/bronze",
                 f"{root}/_checkpoint", "stream", run_ts=fx.RUN)
    # source_file holds Spark's part-file names, which no oracle can know
    return spark.read.parquet(f"{root}/bronze").drop("source_file")


@query
def stream_dedup_transactions(spark, sf):
    """The transaction feed as a live stream delivered at least once and out
    of order: the newest years land first, then older ones and full replays,
    over several micro-batches and restarts.  The sink holds each transaction
    once, however late it came."""
    txns = fx.transactions(spark, sf)
    root = scratch_path(spark, "stream-transactions")
    landing, sink, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint"
    year = F.year("txn_date")

    def run():
        ingest_first_seen(spark, landing, txns.schema, sink, ckpt, "stream", ["transaction_id"],
                          run_ts=fx.RUN, max_files_per_trigger=8)
    txns.filter(year >= 1999).write.json(f"{landing}/1-newest")
    run()
    txns.filter(year < 1997).write.json(f"{landing}/2-oldest")
    txns.filter(year >= 1999).write.json(f"{landing}/3-replay")
    run()
    txns.write.json(f"{landing}/4-all")
    run()
    return spark.read.parquet(sink).drop("source_file", BATCH)


@query
def dim_key_returns(spark, sf):
    """Three loads of the document dimension: a third of the customers is not
    there yet, another third drops out when it arrives, then all are back.
    Every customer has the key it was first given."""
    docs = cleaning.latest_per_customer(fx.kyc_documents(spark, sf))
    ledger = warehouse.KeyLedger(spark, scratch_path(spark, "dim-kyc-keys"), "kyc_key", ("customer_id",))
    third = F.col("customer_id") % 3
    for there in (third != 1, third != 0):
        _published(warehouse.dim_document_status(docs.filter(there), "unknown", ledger=ledger), "dim-kyc")
    return warehouse.dim_document_status(docs, "unknown", ledger=ledger)


@query
def star_as_of(spark, sf):
    """The star over two fact days around the changed segments and countries."""
    path = scratch_path(spark, "fact")
    _, customers, documents, _ = _star(spark, sf)
    gold = _published(_gold(spark, sf), "gold")
    for run in (fx.RUN, fx.RUN2):
        known = spark.read.parquet(path) if run != fx.RUN else None
        write_partitioned(warehouse.fact_customer_risk(gold, fx.run_ts(run), known), path, ["date_key"])
    fact = spark.read.parquet(path)
    days = _published(warehouse.dim_date(F.col("txn_date"), fx.transactions(spark, sf), fact), "dim-date")
    return warehouse.star_as_of(fact, customers, documents, days, broadcast_max_rows=1_000_000)


# ------------------------------------------------------------ whole pipeline

LANDED_FORMATS = {"customer_onboarding": "csv", "transaction_feed": "ndjson",
                  "kyc_documents": "json_array", "watchlist_sanctions": "csv",
                  "account_activity": "parquet_stream"}


def land(df: DataFrame, fmt: str, path: str) -> None:
    """Write ``df`` as landing files of a source format."""
    if fmt == "csv":
        df.write.option("header", True).csv(path)
    elif fmt == "ndjson":
        df.write.json(path)
    elif fmt == "json_array":
        write_json_arrays(df, path)
    else:
        df.write.parquet(path)


def land_fixtures(spark, sf, root) -> pipeline.Layout:
    """Write the fixture roles as landing files in their source formats."""
    roles = {"customer_onboarding": fx.customers(spark, sf),
             "transaction_feed": fx.transactions(spark, sf),
             "kyc_documents": fx.kyc_documents(spark, sf),
             "watchlist_sanctions": fx.watchlist(spark, sf),
             "account_activity": fx.activity(spark, sf)}
    landing = f"{root}/landing"

    pipeline.for_each_table(lambda n: land(roles[n], LANDED_FORMATS[n], f"{landing}/{n}"), roles)
    return pipeline.Layout(landing=landing, root=root, formats=dict(LANDED_FORMATS),
                           schemas={n: d.schema for n, d in roles.items()})


@query
def pipeline_customer_360(spark, sf):
    """Landing -> bronze -> silver -> contracts -> gold."""
    lay = land_fixtures(spark, sf, scratch_path(spark, "pipeline"))
    pipeline.run_tables(spark, lay, fx.RUN, CFG)
    pipeline.run_gold(spark, lay, fx.RUN, CFG)
    return lay.store(spark).read("gold", "customer_360")


@query
def pipeline_reference_files(spark, sf):
    """The five sources in their declared types (dates as text in the account
    files), read by the default layout; the typed silver accounts."""
    lay = pipeline.Layout(landing=scratch_path(spark, "declared"), root=scratch_path(spark, "declared-lake"))
    activity = fx.activity(spark, sf).withColumns({
        "last_activity_date": F.date_sub(F.lit(fx.AS_OF).cast("date"), F.col("days_since_activity").cast("int")),
        "batch_hour": F.lit("2024-01-30T10:00:00")})
    roles = {"customer_onboarding": fx.customers(spark, sf), "transaction_feed": fx.transactions(spark, sf),
             "kyc_documents": fx.kyc_documents(spark, sf), "watchlist_sanctions": fx.watchlist(spark, sf),
             "account_activity": activity}
    for name, df in roles.items():
        declared = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in SOURCES[name].fields])
        land(declared, lay.formats[name], f"{lay.landing}/{name}")
    pipeline.run_tables(spark, lay, fx.RUN, CFG)
    return lay.store(spark).read("silver", "account_activity").select(
        "account_id", "customer_id", "balance", "balance_tier", "last_activity_date", "days_since_activity",
        "dormant_flag", "batch_hour")


@query
def scd2_stored_two_runs(spark, sf):
    """Two runs stored as changes; the second one first with a wrong batch,
    which its re-run replaces."""
    store = TableStore(spark, scratch_path(spark, "scd2-store"))
    batch = fx.scd2_batch1(spark, sf)
    wrong = batch.withColumn("customer_segment", F.lit("WRONG"))
    for df, run in ((batch, fx.RUN), (wrong, fx.RUN2), (fx.customers_v2(spark, sf), fx.RUN2)):
        store.apply_scd2(df, "silver", "customers", KEYS, TRACKED, run, broadcast_max_rows=None)
    return store.read("silver", "customers")


@query
def scd2_corrected_rerun(spark, sf):
    """A run applied with a wrong batch, then again with the right one and
    with rows that have no key: as if only the right rows had come."""
    batch = fx.scd2_batch1(spark, sf)
    history = scd2.scd2_initial(batch, fx.RUN)
    wrong = batch.withColumn("customer_segment", F.lit("WRONG"))
    history = scd2.scd2_apply(history, wrong, KEYS, TRACKED, fx.RUN2)
    right = fx.customers_v2(spark, sf)
    no_key = right.withColumn("customer_id", F.lit(None).cast("long"))
    return scd2.scd2_apply(history, right.unionByName(no_key), KEYS, TRACKED, fx.RUN2)
