"""Incremental file ingestion: exactly-once across restarts, equals batch."""

from pyspark.sql import functions as F

from riskview.streaming.ingest import ingest_files
from tests.conftest import SF_SMALL


def test_restart_and_new_files(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    part = F.col("event_id") % 3
    src, sink, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    # files at any depth are seen
    ev.filter((part == 0) & (F.col("event_id") % 2 == 0)).write.parquet(f"{src}/2024-01-30/a")
    ev.filter((part == 0) & (F.col("event_id") % 2 == 1)).coalesce(1).write.mode("append").parquet(src)
    r1 = ingest_files(spark, src, ev.schema, sink, ck, "stream", run_ts="2024-01-31 00:00:00")
    n0 = ev.filter(part == 0).count()
    assert r1.rows == n0 and spark.read.parquet(sink).count() == n0
    r2 = ingest_files(spark, src, ev.schema, sink, ck, "stream", run_ts="2024-01-31 00:00:00")
    assert r2.rows == 0 and spark.read.parquet(sink).count() == n0
    ev.filter(part == 1).coalesce(1).write.mode("append").parquet(src)
    r3 = ingest_files(spark, src, ev.schema, sink, ck, "stream", run_ts="2024-02-01 00:00:00")
    n1 = ev.filter(part == 1).count()
    assert r3.rows == n1
    out = spark.read.parquet(sink)
    assert out.count() == n0 + n1
    assert {r.ingest_day for r in out.select("ingest_day").distinct().collect()} == {31, 1}
    names = {r.source_file for r in out.select("source_file").distinct().collect()}
    assert all(n.startswith("part-") and n.endswith(".parquet") for n in names)
    batch = ev.filter(part <= 1)
    assert out.select(*ev.columns).exceptAll(batch).count() == 0
    assert batch.exceptAll(out.select(*ev.columns)).count() == 0


def test_first_seen_keeps_records_however_late(spark, tmpdir_path):
    """A record older than everything seen before is new, not late; replays go."""
    from riskview.streaming.ingest import ingest_first_seen
    schema = "transaction_id string, txn_date timestamp, amount double"
    src, sink, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"

    def land(name, *rows):
        df = spark.createDataFrame([(i, d, 1.0) for i, d in rows], "transaction_id string, d string, amount double")
        df.selectExpr("transaction_id", "CAST(d AS TIMESTAMP) AS txn_date", "amount").coalesce(1).write.json(f"{src}/{name}")

    def run():
        ingest_first_seen(spark, src, spark.createDataFrame([], schema).schema, sink, ck, "stream",
                          ["transaction_id"], run_ts="2024-01-31 00:00:00", max_files_per_trigger=1)
        return sorted(r.transaction_id for r in spark.read.parquet(sink).collect())

    land("a", ("T1", "2024-06-01"), ("T1", "2024-06-01"))
    assert run() == ["T1"]
    land("b", ("T2", "2024-01-01"), ("T3", "2024-06-02"))
    land("c", ("T1", "2024-06-01"), ("T0", "1999-01-01"))
    assert run() == ["T0", "T1", "T2", "T3"]
    assert run() == ["T0", "T1", "T2", "T3"]


def test_archive_keeps_listing_small_and_output_exactly_once(spark, tmpdir_path):
    import glob
    import time
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, sink, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    arch = f"{tmpdir_path}/archive"
    part = F.col("event_id") % 2

    def run():
        return ingest_files(spark, f"{src}/*", ev.schema, sink, ck, "stream",
                            run_ts="2024-01-31 00:00:00", archive_dir=arch)

    def landed(d):
        return len(glob.glob(f"{d}/**/*.parquet", recursive=True))

    ev.filter(part == 0).write.parquet(f"{src}/a")
    first = landed(src)
    run()
    ev.filter(part == 1).write.parquet(f"{src}/b")
    r2 = run()
    assert r2.rows == ev.filter(part == 1).count()
    deadline = time.time() + 15                  # the cleaner may run on its own thread
    while landed(arch) < first and time.time() < deadline:
        time.sleep(0.5)
    assert landed(arch) == first                 # the first batch's files moved out
    assert landed(src) == landed(f"{src}/b")     # only the unarchived batch is listed
    r3 = run()
    assert r3.rows == 0
    out = spark.read.parquet(sink).select(*ev.columns)
    assert out.count() == ev.count() and out.exceptAll(ev).count() == 0


def test_first_seen_rejects_every_record_without_a_key(spark, tmpdir_path):
    import os

    from riskview.streaming.ingest import ingest_first_seen
    src, sink, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    schema = spark.createDataFrame([], "transaction_id string, amount double").schema
    os.makedirs(src)

    def land(name, *lines):
        with open(f"{src}/{name}.json", "w") as f:
            f.write("\n".join(lines) + "\n")
        r = ingest_first_seen(spark, src, schema, sink, ck, "stream", ["transaction_id"],
                              run_ts="2024-01-31 00:00:00", max_files_per_trigger=1)
        return r.rows, r.rejected, r.repeated

    assert land("a", '{"transaction_id": "T1", "amount": 1}', '{"amount": 2}', '{"amount": 3}', "{broken") == (4, 3, 0)
    assert land("b", '{"transaction_id": "T1", "amount": 1}', '{"amount": 2}') == (2, 1, 1)
    assert land("c", '{"transaction_id": "T2", "amount": 5}') == (1, 0, 0)
    assert sorted(r.transaction_id for r in spark.read.parquet(sink).collect()) == ["T1", "T2"]
    assert sorted(r.amount or 0 for r in spark.read.parquet(f"{sink}-rejects").collect()) == [0, 2, 2, 3]


def test_first_seen_is_state_and_reads_nothing_back(spark, tmpdir_path):
    """A run whose sink is empty still knows every key, so the sink is never
    read; and what a run reads is what arrived."""
    from riskview.streaming.ingest import ingest_first_seen
    schema = spark.createDataFrame([], "transaction_id long, amount double").schema
    src, ck = f"{tmpdir_path}/in", f"{tmpdir_path}/ck"

    def run(lo, hi, sink):
        spark.range(lo, hi).selectExpr("id AS transaction_id", "1.0D AS amount").coalesce(2).write.json(f"{src}/{lo}-{hi}")
        r = ingest_first_seen(spark, src, schema, f"{tmpdir_path}/{sink}", ck, "stream", ["transaction_id"],
                              run_ts="2024-01-31 00:00:00")
        got = sorted(x.transaction_id for x in spark.read.parquet(f"{tmpdir_path}/{sink}").collect())
        return r, got

    r, got = run(0, 5000, "a")
    assert (r.rows, r.repeated, r.rejected) == (5000, 0, 0) and got == list(range(5000))
    r, got = run(4990, 5010, "b")  # another sink: the keys are not in it
    assert (r.rows, r.repeated, r.rejected) == (20, 10, 0) and got == list(range(5000, 5010))
    assert r.batches == 1
