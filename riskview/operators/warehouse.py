"""Star schema: dense surrogate keys, dimensions, the risk fact, rollups.

Surrogate keys are dense (1..n), deterministic and follow the natural order
of the rows, without a single-partition window over the data: the rows are
range-partitioned and sorted on the (unique) order, each row gets its
position inside its partition, and each partition's offset is the running
total of the partition sizes (one row per partition).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskview.operators.asof import as_of
from riskview.operators.joins import broadcast_if_small
from riskview.operators.scd2 import current_rows
from riskview.operators.scoring import money_sum
from riskview.session import scratch_path

# monotonically_increasing_id() = partition index << 33 | row index in partition
_ROW_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str], mid: str = "__rv_mid") -> DataFrame:
    """``df`` globally sorted on ``order`` with ``mid`` =
    ``monotonically_increasing_id()`` (partition index in the high bits,
    position inside the partition in the low ``_ROW_BITS``), written once to
    the shared scratch folder and read back.

    The global sort takes its range boundaries from a sample of the whole
    order, so with a unique order a natural key holding a third of the rows
    is still spread over many partitions.  Materialising the ids means every
    later reader sees the same numbering and the lineage is cut, so a lost
    executor can never re-number rows differently.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    (df.orderBy(*order).withColumn(mid, F.monotonically_increasing_id())
     .write.parquet(path))
    return spark.read.parquet(path)


def dense_keys(df: DataFrame, key_name: str, order: Sequence[str],
               base: int = 0) -> DataFrame:
    """Add ``key_name`` = ``base`` + rank of the row under ``order`` (1-based).

    ``order`` should be unique per row (ties get distinct keys in arbitrary
    order).  Rows are numbered inside sorted range partitions
    (``number_rows``); only the per-partition counts - at most one row per
    shuffle partition, so a proven size bound - are summed in one task and
    broadcast back.
    """
    mid, part, off = "__rv_mid", "__rv_part", "__rv_off"
    numbered = number_rows(df, order, mid)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy(F.shiftright(mid, _ROW_BITS).alias(part))
               .agg(F.count(F.lit(1)).alias("__rv_n"))
               .select(part, F.coalesce(F.sum("__rv_n").over(before), F.lit(0))
                       .alias(off)))
    row_in_part = F.col(mid).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (numbered.join(F.broadcast(offsets),
                          F.shiftright(F.col(mid), _ROW_BITS) == F.col(part))
            .withColumn(key_name, (F.lit(base) + F.col(off) + row_in_part + 1)
                        .cast("long"))
            .drop(mid, part, off))


def extend_keys(new_rows: DataFrame, existing: DataFrame, key_name: str,
                natural: Sequence[str], order: Sequence[str],
                known: DataFrame | None = None) -> DataFrame:
    """Reload: rows whose natural key already has a key keep it; only new
    natural keys are numbered, after the largest existing key.  ``known`` (by
    default ``existing``) are the rows whose keys may be kept.

    Keys are unique among ``existing`` and the result.  That a key is never
    given again after its row has gone is what ``KeyLedger`` adds."""
    known = (existing if known is None else known).select(*natural, key_name)
    matched = new_rows.join(known, list(natural), "left")
    have = matched.filter(F.col(key_name).isNotNull())
    fresh = matched.filter(F.col(key_name).isNull()).drop(key_name)
    top = existing.agg(F.max(key_name)).first()[0] or 0   # one scalar
    return have.unionByName(dense_keys(fresh, key_name, order, base=int(top)))


@dataclass(frozen=True)
class KeyLedger:
    """Every key that a table has ever given out: ``natural`` and ``key``, as
    an append-only table of its own that outlives the published rows.

    A row that left and comes back finds its key again, and a new one is
    numbered after the largest key ever given, so no key names two rows over
    the life of the table.  Keys are recorded before they are handed out; a run
    that is cut off in between finds them again.  One writer at a time.
    """

    spark: SparkSession
    path: str
    key: str
    natural: tuple[str, ...]

    def known(self) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        # an append that was cut off and done again may repeat rows
        return self.spark.read.parquet(self.path).dropDuplicates([*self.natural])

    def seed(self, published: DataFrame | None) -> None:
        """Record the keys of a table published before it had a ledger."""
        if published is not None and self.known() is None:
            self._record(published)

    def _record(self, rows: DataFrame) -> None:
        rows.select(*self.natural, F.col(self.key).cast("long")).write.mode("append").parquet(self.path)

    def keyed(self, rows: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
        """``rows`` (unique on the natural key) with their keys for life; new
        ones are numbered in ``order`` (the natural key by default)."""
        order = list(order or self.natural)
        known = self.known()
        if known is None:
            fresh, have = dense_keys(rows, self.key, order), None
        else:
            met = rows.join(known, list(self.natural), "left")
            have = met.where(F.col(self.key).isNotNull())
            top = known.agg(F.max(self.key)).first()[0] or 0   # one scalar
            fresh = dense_keys(met.where(F.col(self.key).isNull()).drop(self.key), self.key, order, base=int(top))
        self._record(fresh)  # numbered rows are stored, so these are the keys that are returned
        return fresh if have is None else have.unionByName(fresh)


DIM_CUSTOMER_ATTRS = ["customer_id", "full_name", "country", "customer_segment",
                      "pep_flag", "effective_from", "effective_to", "is_current"]
DIM_CUSTOMER_NATURAL = ["customer_id", "effective_from"]


def dim_customer(history: DataFrame, existing: DataFrame | None = None,
                 ledger: KeyLedger | None = None) -> DataFrame:
    """All SCD2 versions, one key per (customer_id, effective_from).

    With ``existing`` (the previously published dimension) a version keeps
    the key it already has - only its closing columns may change - and only
    new versions are numbered, after the largest existing key.  A ``ledger``
    keeps keys for life, also of versions that a re-run took back.
    """
    d = history.select(*DIM_CUSTOMER_ATTRS).distinct()
    if ledger is not None:
        ledger.seed(existing)
        keyed = ledger.keyed(d)
    elif existing is None:
        keyed = dense_keys(d, "customer_key", DIM_CUSTOMER_NATURAL)
    else:
        keyed = extend_keys(d, existing, "customer_key", DIM_CUSTOMER_NATURAL,
                            DIM_CUSTOMER_NATURAL)
    return keyed.select("customer_key", *DIM_CUSTOMER_ATTRS)


def dim_document_status(latest_docs: DataFrame,
                        default_verifier: str | None = None,
                        existing: DataFrame | None = None,
                        ledger: KeyLedger | None = None) -> DataFrame:
    """One row per customer's current document, keyed by customer_id order;
    with ``existing`` a customer keeps its key and new ones follow.  With a
    ``ledger`` also one that dropped out and returned keeps it, and its key
    goes to nobody else meanwhile."""
    verifier = (F.col("verified_by") if "verified_by" in latest_docs.columns
                else F.lit(default_verifier).cast("string"))
    d = latest_docs.select("customer_id", "doc_status", "doc_type",
                           F.col("expiry_date").cast("string").alias("expiry_date"),
                           verifier.alias("verified_by"))
    if ledger is not None:
        ledger.seed(existing)
        keyed = ledger.keyed(d)
    else:
        keyed = (dense_keys(d, "kyc_key", ["customer_id"]) if existing is None else
                 extend_keys(d, existing, "kyc_key", ["customer_id"], ["customer_id"]))
    return keyed.select("kyc_key", "customer_id", "doc_status", "doc_type", "expiry_date",
                        "verified_by")


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def dim_date(dates: Column, source: DataFrame, date_keys: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every day between the smallest and largest value of
    ``dates`` in ``source`` and of the fact's ``date_keys(date_key)``, so every
    fact row has its day.  Its size is the calendar span, not the data."""
    days = source.select(F.to_date(dates).alias("d"))
    if date_keys is not None:
        days = days.union(date_keys.select(
            F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")))
    bounds = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY")))
                         .alias("full_date"))
    d = F.col("full_date")
    return days.select(date_key(d).alias("date_key"), d,
                       F.year(d).alias("year"), F.month(d).alias("month"),
                       F.dayofmonth(d).alias("day"), F.quarter(d).alias("quarter"),
                       F.date_format(d, "MMMM").alias("month_name"))


FACT_MEASURES = ("txn_count", "txn_total_amt", "cross_border_count", "risk_score",
                 "kyc_risk_level", "aml_flag", "dormancy_alert", "high_risk_profile",
                 "velocity_risk", "days_since_activity", "balance_tier")


def fact_rows(gold: DataFrame, run_date: Column) -> DataFrame:
    """The fact's columns without its surrogate key (lazy): one row per
    customer of the gold view for the run's date, flags never NULL."""
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) if c in
             ("aml_flag", "dormancy_alert", "high_risk_profile") else F.col(c)
             for c in FACT_MEASURES]
    return gold.select("customer_id", date_key(run_date).alias("date_key"), *flags)


def fact_customer_risk(gold: DataFrame, run_date: Column,
                       existing: DataFrame | None = None, ledger: KeyLedger | None = None) -> DataFrame:
    """``fact_rows`` with a ``risk_key`` in customer order.

    ``existing`` is the published fact of all days: a re-run of a day gives its
    customers their keys back, and every other row is numbered after the
    largest key of any published day.  With a ``ledger`` on customer and date a
    key never names two rows, also where a re-run of a day holds fewer
    customers than before.
    """
    rows = fact_rows(gold, run_date)
    if ledger is not None:
        ledger.seed(existing)
        keyed = ledger.keyed(rows)
    elif existing is None:
        keyed = dense_keys(rows, "risk_key", ["customer_id"])
    else:
        keyed = extend_keys(rows, existing, "risk_key", ["customer_id"], ["customer_id"],
                            known=existing.filter(F.col("date_key") == date_key(run_date)))
    return keyed.select("risk_key", "customer_id", "date_key", *FACT_MEASURES)


def star_rollup(fact: DataFrame, dim_cust: DataFrame, dim_kyc: DataFrame, dim_dates: DataFrame,
                broadcast_max_rows: int | None = None) -> DataFrame:
    """Risk by segment, country, document status, month and level.

    The fact carries natural keys, so the customer dimension joins by its
    current versions, the document dimension by customer and the calendar by
    ``date_key``.  ``broadcast_max_rows`` broadcasts a dimension once it is
    proven to hold at most that many rows; the fact is then shuffled only for
    the grouping, after partial sums.
    """
    size = _sized(broadcast_max_rows)
    cust = size(current_rows(dim_cust).select("customer_id", "customer_segment", "country"))
    return _rollup(fact.join(cust, "customer_id"), dim_kyc, dim_dates, size)


def star_as_of(fact: DataFrame, dim_cust: DataFrame, dim_kyc: DataFrame, dim_dates: DataFrame,
               broadcast_max_rows: int | None = None) -> DataFrame:
    """``star_rollup`` with every fact day under the segment and country that
    the customer had at the end of that day.  A customer without a version by
    then is counted under NULL."""
    size = _sized(broadcast_max_rows)
    day = F.to_timestamp(F.col("date_key").cast("string"), "yyyyMMdd")
    dated = fact.withColumn("__day_end", day + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 0.000001 SECOND"))
    versions = dim_cust.select("customer_id", "effective_from", "effective_to", "customer_segment", "country")
    met = as_of(dated, versions, ["customer_id"], "__day_end", "effective_from")
    open_then = F.col("effective_to") > F.col("__day_end")
    met = met.withColumns({c: F.when(open_then, F.col(c)) for c in ("customer_segment", "country")})
    return _rollup(met, dim_kyc, dim_dates, size)


def _sized(broadcast_max_rows: int | None):
    return (lambda d: broadcast_if_small(d, broadcast_max_rows)) if broadcast_max_rows is not None else (lambda d: d)


def _rollup(rows: DataFrame, dim_kyc: DataFrame, dim_dates: DataFrame, size) -> DataFrame:
    kyc = size(dim_kyc.select("customer_id", "doc_status"))
    days = size(dim_dates.select("date_key", "year", "month"))
    return (rows.join(kyc, "customer_id", "left").join(days, "date_key")
            .groupBy("customer_segment", "country", "doc_status", "year", "month", "kyc_risk_level")
            .agg(F.count(F.lit(1)).alias("customers"),
                 money_sum(F.col("txn_total_amt")).alias("total_amount"),
                 F.avg("risk_score").alias("avg_score")))
