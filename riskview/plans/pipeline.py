"""The layered pipeline: landing -> bronze -> silver -> gold -> warehouse.

Each step reads what the previous one published and publishes its own
tables; nothing is handed over in driver memory.  Every step takes the run
timestamp, so a run is reproducible and a re-run of the same day replaces
that day's bronze partitions, history changes and fact partition instead of
duplicating them (recovery from a lost job is a re-run).  Each source's bronze
-> silver chain runs concurrently with the others.  Gold is built only if the
silver tables meet their contracts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskview.config import DedupKeys, RiskConfig
from riskview.functions.masking import DEFAULT_MASKS
from riskview.functions.metadata import with_ingest_metadata, with_layer_metadata
from riskview.operators import cleaning, quality, quarantine, reports, scd2, warehouse
from riskview.plans import customer_360 as c360
from riskview.schemas import SILVER_CONTRACTS, SILVER_TYPES, SOURCE_FORMATS, SOURCES
from riskview.session import scratch_scope
from riskview.sources.readers import CORRUPT, TEXT_FORMATS, read_source
from riskview.sources.store import TableStore, run_stamp, write_partitioned
from riskview.streaming.ingest import INGEST_PARTITIONS, for_each_new_batch, ingest_files

PIPELINE_TAGS = {"csv": "batch", "ndjson": "batch_json", "json_array": "batch_json",
                 "parquet_stream": "file_stream"}

# Recency order used to pick the surviving row per natural key: business
# timestamp first, then ingestion time (columns absent from a table are
# skipped).  The documents key is the customer (one document per customer).
DEDUP_ORDER: dict[str, tuple[str, ...]] = {
    "customer_onboarding": ("record_date", "ingestion_timestamp"),
    "transaction_feed": ("txn_date", "ingestion_timestamp"),
    "kyc_documents": ("verification_date", "doc_id", "ingestion_timestamp"),
    "watchlist_sanctions": ("record_date", "ingestion_timestamp"),
    "account_activity": ("batch_hour", "ingestion_timestamp"),
}
SILVER_PARTITIONS = ("silver_year", "silver_month", "silver_day")


@dataclass(frozen=True)
class Layout:
    """Where things live.  ``landing/<source>/`` holds the arriving files."""
    landing: str
    root: str
    formats: Mapping[str, str] = field(default_factory=lambda: dict(SOURCE_FORMATS))
    schemas: Mapping[str, T.StructType] = field(default_factory=lambda: dict(SOURCES))
    # partition columns of silver tables other than the run's date
    silver_partitions: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    # move ingested stream files to ``<root>/_archive`` so the landing path
    # the stream lists stays small (off by default: it changes the landing zone)
    archive_stream_files: bool = False
    # share of a column's values that may be corrupt or miscast before a run raises
    most_bad: float = 1.0

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/_checkpoints"

    def store(self, spark: SparkSession) -> TableStore:
        return TableStore(spark, self.root)


def for_each_table(fn: Callable[[str], None], names: Iterable[str],
                   parallel: bool = True) -> None:
    """Run ``fn(name)`` for every table.  The tables of one layer are
    independent, so their jobs are submitted concurrently from driver
    threads and share the executors instead of queueing one after another;
    the first failure is raised once all have finished."""
    names = list(names)
    if not parallel or len(names) < 2:
        for n in names:
            fn(n)
        return
    with ThreadPoolExecutor(max_workers=len(names), thread_name_prefix="riskview") as ex:
        futures = [ex.submit(fn, n) for n in names]
    for f in futures:
        f.result()


def bronze_table(spark: SparkSession, lay: Layout, name: str, run_ts: str) -> None:
    """One landing source -> its bronze table (ingest-date partitions)."""
    fmt = lay.formats[name]
    src, dst = f"{lay.landing}/{name}", f"{lay.bronze}/{name}"
    if fmt == "parquet_stream":
        archive = f"{lay.root}/_archive/{name}" if lay.archive_stream_files else None
        ingest_files(spark, src, lay.schemas[name], dst,
                     f"{lay.checkpoints}/{name}", PIPELINE_TAGS[fmt], run_ts=run_ts,
                     archive_dir=archive)
        return
    df = read_source(spark, name, src, fmt, lay.schemas[name], keep_corrupt=fmt in TEXT_FORMATS)
    write_partitioned(with_ingest_metadata(df, PIPELINE_TAGS[fmt], run_ts=run_ts),
                      dst, INGEST_PARTITIONS)


def run_bronze(spark: SparkSession, lay: Layout, run_ts: str,
               parallel: bool = True) -> None:
    """Landing files -> bronze tables partitioned by ingest date."""
    for_each_table(lambda name: bronze_table(spark, lay, name, run_ts), lay.formats,
                   parallel)


def bronze_schema(lay: Layout, name: str) -> T.StructType:
    """Columns of a bronze table: the source's, the unparsed text of corrupt
    records (text formats), lineage and the ingest date."""
    fields = list(lay.schemas[name].fields)
    if lay.formats[name] in TEXT_FORMATS:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    fields += [T.StructField("ingestion_timestamp", T.TimestampType()),
               T.StructField("source_file", T.StringType()), T.StructField("pipeline", T.StringType())]
    return T.StructType(fields + [T.StructField(c, T.IntegerType()) for c in INGEST_PARTITIONS])


def read_bronze(spark: SparkSession, lay: Layout, name: str,
                run_ts: str | None = None) -> DataFrame:
    """A bronze table, or one run's ingest day: that directory alone is
    listed, under the declared schema."""
    root = f"{lay.bronze}/{name}"
    reader = spark.read.schema(bronze_schema(lay, name))
    if run_ts is None:
        return reader.parquet(root)
    day = dt.datetime.fromisoformat(run_ts)
    return reader.option("basePath", root).parquet(
        f"{root}/ingest_year={day.year}/ingest_month={day.month}/ingest_day={day.day}")


def corrupt_records(spark: SparkSession, lay: Layout, run_ts: str | None = None) -> DataFrame:
    """Good and corrupt records of every text source in bronze (or of one
    run): ``table_name, good, corrupt``."""
    parts = [read_bronze(spark, lay, name, run_ts).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("good"), F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"))
        .select(F.lit(name).alias("table_name"), "good", "corrupt")
        for name, fmt in lay.formats.items() if fmt in TEXT_FORMATS]
    return reduce(DataFrame.unionByName, parts)


def silver_input(df: DataFrame, name: str) -> DataFrame:
    """Bronze rows that could be parsed, text columns in their silver types
    (a value that is none of that type becomes NULL)."""
    if CORRUPT in df.columns:
        df = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    types = dict(df.dtypes)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in SILVER_TYPES.get(name, {}).items()
                           if types.get(c) == "string"})


def quarantine_bad(df: DataFrame, lay: Layout, name: str, part: str,
                   keys: DedupKeys = DedupKeys()) -> None:
    """Set the corrupt records and miscast values of bronze rows aside under
    ``<root>/quarantine``: one narrow scan writes the values and counts them.
    ``part`` names the run or stream batch; the same one again replaces its
    own files.  Raises after writing if a column exceeds ``lay.most_bad``."""
    types = {c: t for c, t in SILVER_TYPES.get(name, {}).items() if dict(df.dtypes).get(c) == "string"}
    corrupt = CORRUPT if CORRUPT in df.columns else None
    if not types and corrupt is None:
        return
    rows, seen, columns = quarantine.set_aside(df, types, corrupt, keys.keys[name], ("source_file", "ingestion_timestamp"))

    def write(out: DataFrame, kind: str) -> None:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{lay.root}/quarantine/{kind}/table_name={name}/part={part}"))

    write(rows, "values")
    counts = quarantine.tally(seen, columns)
    write(df.sparkSession.createDataFrame(counts, "column_name string, rows long, bad long").coalesce(1), "counts")
    quarantine.judge(counts, lay.most_bad, name)


def quarantine_report(spark: SparkSession, lay: Layout) -> DataFrame:
    """Good and bad values of every judged column over all runs and stream
    batches: ``table_name, column_name, rows, good, bad``."""
    counts = spark.read.schema("column_name string, rows long, bad long, table_name string, part string").parquet(
        f"{lay.root}/quarantine/counts")
    return counts.groupBy("table_name", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") - F.col("bad")).alias("good"), F.sum("bad").alias("bad"))


def quarantined(spark: SparkSession, lay: Layout) -> DataFrame:
    """The values set aside: ``column_name, value, key``, lineage,
    ``table_name`` and ``part``."""
    return spark.read.schema("column_name string, value string, key string, source_file string, "
                             "ingestion_timestamp timestamp, table_name string, part string").parquet(
        f"{lay.root}/quarantine/values")


def silver_dedup(df: DataFrame, name: str, keys: DedupKeys = DedupKeys()) -> DataFrame:
    """Latest row per natural key.  After the recency order, every other
    column breaks ties, so two differing copies with the same timestamps
    always resolve to the same survivor (a total order over distinct rows)."""
    key = list(keys.keys[name])
    order = [c for c in DEDUP_ORDER[name] if c in df.columns]
    atomic = (T.NumericType, T.StringType, T.BooleanType, T.DateType,
              T.TimestampType, T.TimestampNTZType, T.BinaryType)
    tiebreak = [f.name for f in df.schema.fields
                if f.name not in key and f.name not in order
                and isinstance(f.dataType, atomic)]
    return cleaning.dedup_latest(df, key, order + tiebreak)


def stream_silver(spark: SparkSession, lay: Layout, name: str, run_ts: str) -> None:
    """Silver of a stream-fed table: the bronze rows that silver has not
    consumed, whatever day they are filed under, merged into the previous
    snapshot.  The consumed rows are kept by the stream's own checkpoint; a
    batch that was cut off comes again and merges to the same rows.  The work
    follows the key parts that a batch touches (``TableStore.merge``)."""
    schema = bronze_schema(lay, name)
    bronze = spark.readStream.schema(schema).parquet(f"{lay.bronze}/{name}")

    def merge(batch: DataFrame, batch_id: int | None) -> None:
        store = lay.store(batch.sparkSession)
        if batch_id is not None:
            quarantine_bad(batch, lay, name, f"batch-{batch_id}")
        store.merge(silver_input(batch, name), "silver", name, DedupKeys().keys[name],
                    lambda rows: with_layer_metadata(silver_dedup(rows, name), "silver", run_ts),
                    lay.silver_partitions.get(name, SILVER_PARTITIONS))

    for_each_new_batch(bronze, f"{lay.checkpoints}/silver-{name}", merge)
    if not lay.store(spark).exists("silver", name):  # nothing has arrived yet
        merge(spark.createDataFrame([], schema), None)


def silver_table(spark: SparkSession, lay: Layout, name: str, run_ts: str,
                 cfg: RiskConfig = RiskConfig()) -> None:
    """One bronze table -> silver: deduplicated, and for customers masked
    and kept as SCD2 history.  A customer row without an id cannot enter the
    history; it goes to ``customer_onboarding_rejects``, a day a run."""
    store = lay.store(spark)
    if lay.formats[name] == "parquet_stream":
        stream_silver(spark, lay, name, run_ts)
        return
    # A batch source lands a full extract every run: its own ingest day is
    # the whole source.
    landed = read_bronze(spark, lay, name, run_ts)
    quarantine_bad(landed, lay, name, f"run-{run_stamp(run_ts)}")
    bronze = silver_input(landed, name)
    if name == "customer_onboarding":
        keys = list(cfg.scd2.keys)
        rejects = with_layer_metadata(cleaning.mask_customer_pii(scd2.null_key_rows(bronze, keys)), "silver", run_ts)
        store.publish(rejects, "silver", f"{name}_rejects", SILVER_PARTITIONS)
        store.apply_scd2(cleaning.mask_customer_pii(silver_dedup(bronze, name)), "silver", name,
                         keys, list(cfg.scd2.tracked), run_ts)
    else:
        store.publish(with_layer_metadata(silver_dedup(bronze, name), "silver", run_ts), "silver", name,
                      lay.silver_partitions.get(name, SILVER_PARTITIONS))


def run_silver(spark: SparkSession, lay: Layout, run_ts: str,
               cfg: RiskConfig = RiskConfig(), parallel: bool = True) -> None:
    """Mask, deduplicate, keep SCD2 history for customers; publish the rest."""
    for_each_table(lambda name: silver_table(spark, lay, name, run_ts, cfg), lay.formats,
                   parallel)


def run_tables(spark: SparkSession, lay: Layout, run_ts: str,
               cfg: RiskConfig = RiskConfig(), parallel: bool = True) -> None:
    """Landing -> bronze -> silver for every source, one chain per table.
    The chains are independent, so a small table does not wait at a layer
    barrier for the largest one."""
    def chain(name: str) -> None:
        bronze_table(spark, lay, name, run_ts)
        silver_table(spark, lay, name, run_ts, cfg)
    for_each_table(chain, lay.formats, parallel)


def gold_inputs(spark: SparkSession, lay: Layout) -> c360.Inputs:
    s = lay.store(spark)
    return c360.Inputs(customers=s.read("silver", "customer_onboarding"),
                       transactions=s.read("silver", "transaction_feed"),
                       documents=s.read("silver", "kyc_documents"),
                       watchlist=s.read("silver", "watchlist_sanctions"),
                       activity=s.read("silver", "account_activity"),
                       unique_documents=True)


def silver_column_types(lay: Layout, name: str) -> dict[str, str]:
    """The types that the silver columns of a table must have."""
    types = {f.name: f.dataType.simpleString() for f in lay.schemas[name].fields} if name in lay.schemas else {}
    types |= {c: t for c, t in SILVER_TYPES.get(name, {}).items() if types.get(c) == "string"}
    if name == "customer_onboarding":  # masked, and kept as history
        types |= {c: "string" for c in DEFAULT_MASKS}
        types |= {"effective_from": "timestamp", "effective_to": "timestamp", "is_current": "boolean"}
    return types


def silver_contract(spark: SparkSession, lay: Layout, strict: bool = True) -> DataFrame:
    """The contract report of the silver tables.  With ``strict`` a column that
    is missing or of another type raises ``SchemaContractError`` - the alert -
    before any job runs."""
    store = lay.store(spark)
    tables = {n: store.read("silver", n) for n in SILVER_CONTRACTS}
    types = {n: silver_column_types(lay, n) for n in SILVER_CONTRACTS}
    return quality.schema_report(tables, SILVER_CONTRACTS, strict=strict, expected_types=types)


def run_gold(spark: SparkSession, lay: Layout, run_ts: str,
             cfg: RiskConfig = RiskConfig()) -> None:
    """Silver -> the unified view, behind the silver contracts."""
    silver_contract(spark, lay)
    gold = c360.customer_360(gold_inputs(spark, lay), run_ts, cfg)
    # written as the join stage leaves it (no extra shuffle of the view)
    lay.store(spark).publish(gold, "gold", "customer_360")


def external_customer_360(spark: SparkSession, lay: Layout,
                          name: str = "ext_customer_360") -> DataFrame:
    """The published gold view as a SQL-queryable table with the external
    schema (19 columns, declared types), read through the latest commit."""
    from riskview.schemas import EXTERNAL_CUSTOMER_360
    from riskview.sources.readers import register_external_view
    return register_external_view(lay.store(spark).read("gold", "customer_360"), name,
                                  EXTERNAL_CUSTOMER_360)


def run_warehouse(spark: SparkSession, lay: Layout, run_ts: str,
                  parallel: bool = True) -> None:
    """Dimensions as snapshots; the fact replaces only the run's date_key.
    The four outputs are independent and are built concurrently."""
    store = lay.store(spark)

    fact_dir = f"{lay.root}/warehouse/fact_customer_risk"

    def previous(table: str) -> DataFrame | None:
        return store.read("warehouse", table) if store.exists("warehouse", table) else None

    def published_fact() -> DataFrame | None:
        return spark.read.parquet(fact_dir) if path_exists(spark, fact_dir) else None

    def ledger(table: str, key: str, *natural: str) -> warehouse.KeyLedger:
        return warehouse.KeyLedger(spark, f"{lay.root}/warehouse/{table}_keys", key, natural)

    def dim_customer() -> None:
        history = store.read("silver", "customer_onboarding")
        keys = ledger("dim_customer", "customer_key", *warehouse.DIM_CUSTOMER_NATURAL)
        store.publish(warehouse.dim_customer(history, previous("dim_customer"), keys), "warehouse", "dim_customer")

    def dim_kyc_status() -> None:
        docs = store.read("silver", "kyc_documents")
        store.publish(warehouse.dim_document_status(docs, existing=previous("dim_kyc_status"),
                                                    ledger=ledger("dim_kyc_status", "kyc_key", "customer_id")),
                      "warehouse", "dim_kyc_status")

    def fact() -> None:
        gold = store.read("gold", "customer_360")
        run_date = F.lit(run_ts).cast("timestamp")
        f = warehouse.fact_customer_risk(gold, run_date, published_fact(),
                                         ledger("fact_customer_risk", "risk_key", "customer_id", "date_key"))
        # numbering range-sorted the rows on customer_id, so every file holds
        # one contiguous customer range (co-located, with tight min/max
        # statistics); no second shuffle to hash-distribute them
        write_partitioned(f, fact_dir, ["date_key"])

    def dim_date() -> None:
        dates = store.read("silver", "transaction_feed")
        store.publish(warehouse.dim_date(F.col("txn_date"), dates, published_fact()), "warehouse", "dim_date")

    def step(run: Callable[[], None]) -> None:
        with scratch_scope(spark):  # numbered copies go once their table is published
            run()

    steps = {"dim_customer": dim_customer, "dim_kyc_status": dim_kyc_status, "fact_customer_risk": fact}
    for_each_table(lambda name: step(steps[name]), steps, parallel)
    step(dim_date)  # after the fact, whose days it covers


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def star(spark: SparkSession, lay: Layout, broadcast_max_rows: int | None = 1_000_000) -> DataFrame:
    """The star query over the published fact and dimensions: every fact day
    under the attributes that its customers had then."""
    store = lay.store(spark)
    return warehouse.star_as_of(spark.read.parquet(f"{lay.root}/warehouse/fact_customer_risk"),
                                 *[store.read("warehouse", d) for d in ("dim_customer", "dim_kyc_status", "dim_date")],
                                 broadcast_max_rows)


def gold_reports(spark: SparkSession, lay: Layout) -> dict[str, DataFrame]:
    """Summary, distribution and alerts of the published view."""
    gold = lay.store(spark).read("gold", "customer_360")
    return {"summary": reports.gold_summary(gold), "distribution": reports.risk_distribution(gold),
            "screening": reports.screen_summary(gold), "alerts": reports.alert_list(gold)}


def layer_report(spark: SparkSession, lay: Layout, layer: str) -> DataFrame:
    """Rows and columns of every table of a layer and the layer's total; a
    table that cannot be opened is reported with its error instead of failing
    the report."""
    store = lay.store(spark)
    tables, errors = {}, {}
    for name in lay.formats:
        try:
            if layer == "bronze":
                tables[name] = read_bronze(spark, lay, name)
            else:
                tables[name] = store.read(layer, name)
        except Exception as e:  # reported, not raised: this is the report
            errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
    if not tables:
        return spark.createDataFrame(
            [(n, None, None, m) for n, m in errors.items()],
            "table_name string, rows long, columns int, error string")
    return quality.layer_row_counts(tables, errors, total="TOTAL")


def run_all(spark: SparkSession, lay: Layout, run_ts: str,
            cfg: RiskConfig = RiskConfig()) -> None:
    run_tables(spark, lay, run_ts, cfg)
    run_gold(spark, lay, run_ts, cfg)
    run_warehouse(spark, lay, run_ts)
