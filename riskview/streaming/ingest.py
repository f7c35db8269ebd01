"""Incremental file ingestion with Structured Streaming.

Each run processes only files not seen before (the checkpoint's source log
remembers them), appends them with ingestion metadata to a partitioned
Parquet sink whose commit log makes the append exactly-once, and stops when
the backlog is drained (``availableNow``).  A lost executor or a killed run
is recovered by re-running with the same checkpoint.

A feed that is delivered at least once is reduced to first-seen keys by
``ingest_first_seen``.  The keys seen are streaming state without a watermark:
however late a record is, it is dropped only if its key has been seen before,
and a micro-batch costs its own rows, whatever the feed has delivered so far.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskview.functions.metadata import with_ingest_metadata
from riskview.session import scratch_path, scratch_scope

INGEST_PARTITIONS = ("ingest_year", "ingest_month", "ingest_day")
BATCH = "ingest_batch"


@dataclass(frozen=True)
class StreamRun:
    batches: int
    rows: int
    rejected: int = 0
    repeated: int = 0


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet", max_files_per_trigger: int | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """Streaming scan of new files at any depth under ``path`` with a declared
    schema.  (A path pattern finds files where it points, as Spark does.)"""
    r = spark.readStream.schema(schema).format(fmt)
    if "*" not in path:
        r = r.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def _drain(q: StreamingQuery, what: str, timeout_s: float | None, observed: str | None = None) -> StreamRun:
    """Wait for the query's end.  ``observed`` names a metric of the query
    whose ``rows`` count as the rows that arrived."""
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"{what} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    progress = [p for p in q.recentProgress if p.numInputRows > 0]
    rows = [p.observedMetrics[observed]["rows"] if observed in p.observedMetrics else 0 for p in progress] if observed \
        else [p.numInputRows for p in progress]
    return StreamRun(batches=len(progress), rows=sum(rows))


def ingest_files(spark: SparkSession, source_dir: str, schema: T.StructType,
                 sink_dir: str, checkpoint_dir: str, pipeline: str,
                 run_ts: Column | str | None = None, fmt: str = "parquet",
                 partition_by: Sequence[str] = INGEST_PARTITIONS,
                 source_file: bool = True, timeout_s: float | None = None,
                 max_files_per_trigger: int | None = None,
                 archive_dir: str | None = None) -> StreamRun:
    """Run one catch-up pass of the stream: new files -> sink, then stop.

    There is no time limit unless ``timeout_s`` sets one.  The file source
    lists the whole landing path on every trigger, so that cost grows with
    every file ever landed.  With ``archive_dir`` (outside the landing path)
    the files of each committed batch are moved there, keeping the listed set
    to the files not yet archived.  Spark moves them once a later batch with
    data runs.
    """
    options = ({"cleanSource": "archive", "sourceArchiveDir": archive_dir}
               if archive_dir else None)
    df = file_stream(spark, source_dir, schema, fmt, max_files_per_trigger, options)
    df = with_ingest_metadata(df, pipeline, run_ts=run_ts, file_column=source_file)
    q = (df.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint_dir)
         .outputMode("append").partitionBy(*partition_by)
         .trigger(availableNow=True).start(sink_dir))
    return _drain(q, f"stream into {sink_dir}", timeout_s)


def for_each_new_batch(df: DataFrame, checkpoint_dir: str,
                       step: Callable[[DataFrame, int], None],
                       timeout_s: float | None = None, observed: str | None = None) -> StreamRun:
    """Hand every batch of ``df`` that this checkpoint has not seen to
    ``step(batch, id)``, then stop.  A batch comes again if ``step`` was cut
    off, with the same id and rows, so ``step`` must allow that."""
    q = (df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    return _drain(q, f"stream of {checkpoint_dir}", timeout_s, observed)


def ingest_first_seen(spark: SparkSession, source_dir: str, schema: T.StructType,
                      sink_dir: str, checkpoint_dir: str, pipeline: str, keys: Sequence[str],
                      run_ts: Column | str | None = None, fmt: str = "json",
                      timeout_s: float | None = None,
                      max_files_per_trigger: int | None = None,
                      rejects_dir: str | None = None) -> StreamRun:
    """Catch-up pass of a feed that may deliver a record many times: the sink
    holds each key once, the first time it was seen.

    The keys seen are the state of a streaming ``dropDuplicates`` without a
    watermark, one entry a key, hashed over the shuffle partitions that the
    session had when the checkpoint was made (size them for the keys to come)
    and kept in RocksDB on local disk, with its changes in the checkpoint.  A
    micro-batch looks up and adds its own keys only; nothing is read back from
    the sink.  Each batch is written to its own ``ingest_batch`` partition,
    which a repeated batch overwrites with the same keys.  Of records that
    share a key within one micro-batch, one is kept (a repeat is a copy).

    A record that lacks a key (a malformed line lacks all) equals no other:
    every one goes to ``rejects_dir`` (``<sink_dir>-rejects`` unless given),
    laid out like the sink.  The run counts the ``rows`` that arrived, those
    ``rejected`` and the ``repeated`` ones that were dropped.
    """
    rejects_dir = rejects_dir or f"{sink_dir.rstrip('/')}-rejects"
    keyless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    counts: dict[int, tuple[int, int]] = {}
    feed = with_ingest_metadata(
        file_stream(spark, source_dir, schema, fmt, max_files_per_trigger), pipeline, run_ts=run_ts)
    # records without a key skip the state: a marker that no key has keeps them apart from it
    # (counted before the reduction; the scan's own count depends on what filters it takes over)
    keyed = feed.filter(~keyless).observe("first_seen", F.count(F.lit(1)).alias("rows"))
    first = keyed.dropDuplicates(list(keys))
    both = first.withColumn("__lacks", F.lit(False)).union(feed.filter(keyless).withColumn("__lacks", F.lit(True)))

    def publish(rows: DataFrame, n: int, path: str) -> None:
        (rows.drop("__lacks").withColumn(BATCH, F.lit(n).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        path = scratch_path(spark, "first-seen")
        # once: each evaluation of a stateful batch would read the files again
        batch.write.partitionBy("__lacks").parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        size = {r["__lacks"]: r["n"] for r in rows.groupBy("__lacks").agg(F.count("*").alias("n")).collect()}
        counts[n] = size.get(False, 0), size.get(True, 0)
        publish(rows.filter(~F.col("__lacks")), n, sink_dir)
        if counts[n][1]:
            publish(rows.filter("__lacks"), n, rejects_dir)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        with scratch_scope(spark):
            run = for_each_new_batch(both, checkpoint_dir, step, timeout_s, observed="first_seen")
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    kept, rejected = (sum(c) for c in zip(*counts.values())) if counts else (0, 0)
    return replace(run, rows=run.rows + rejected, rejected=rejected, repeated=run.rows - kept)
