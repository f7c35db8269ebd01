"""Snapshots merged by key parts."""

import glob

import pytest
from pyspark.sql import functions as F

from riskview.operators import cleaning
from riskview.sources.store import TableStore


def _rows(spark, ids, v):
    return spark.createDataFrame([(i, v) for i in ids], "k long, v int")


def _latest(rows):
    return cleaning.dedup_latest(rows, ["k"], ["v"])


def _merge(store, rows):
    store.merge(rows, "silver", "t", ["k"], _latest)


def _got(store):
    return sorted((r.k, r.v) for r in store.read("silver", "t").collect())


def test_a_batch_reads_and_writes_only_its_parts(spark, tmpdir_path):
    store = TableStore(spark, tmpdir_path, part_rows=100)
    _merge(store, _rows(spark, range(800), 1))
    root = f"{tmpdir_path}/silver/t"
    assert len(glob.glob(f"{root}/version=0000000001/whole=1/key_parts=8/key_part=*")) == 8
    _merge(store, _rows(spark, [7, 7], 2))
    hit = glob.glob(f"{root}/version=0000000002/whole=0/key_parts=8/key_part=*")
    assert len(hit) == 1
    assert _got(store) == sorted([(i, 1) for i in range(800) if i != 7] + [(7, 2)])
    part = hit[0].rsplit("/", 1)[1]
    for f in glob.glob(f"{root}/version=0000000001/whole=1/key_parts=8/*/*.parquet"):
        if f.split("/")[-2] != part:
            for name in [f, *glob.glob(f.replace("part-", ".part-") + ".crc")]:
                with open(name, "wb") as out:
                    out.write(b"broken")
    _merge(store, _rows(spark, [7], 3))  # opens none of the broken parts
    with pytest.raises(Exception):
        _got(store)
    assert [(r.k, r.v) for r in spark.read.parquet(f"{root}/version=0000000003").filter("k = 7").collect()] == [(7, 3)]


def test_merges_equal_one_reduction(spark, tmpdir_path):
    """Parts that grow, whole rewrites, empty batches, null keys and new
    columns: the contents are those of all rows at once."""
    batches = [[], [(1, 1), (None, 1)], [(i, 2) for i in range(60)], [], [(1, 5), (200, 1)], [(i, 3) for i in range(50, 400)],
               [(None, 7)], [(7, 1), (7, 9)], [(8, 9)], [(9, 9)]]
    store = TableStore(spark, tmpdir_path, part_rows=20, whole_every=3)
    for n, b in enumerate(batches):
        _merge(store, spark.createDataFrame(b, "k long, v int"))
        rows = {}
        for k, v in sum(batches[:n + 1], []):
            rows[k] = max(v, rows.get(k, v))
        got = {r.k: r.v for r in store.read("silver", "t").collect()}
        assert got == rows and store.read("silver", "t").count() == len(rows)
    counts = {p.split("key_parts=")[1] for p in glob.glob(f"{tmpdir_path}/silver/t/version=*/whole=1/key_parts=*")}
    assert len(counts) > 1  # grown parts were split
    again = store.versions("silver", "t")
    _merge(store, spark.createDataFrame([], "k long, v int"))
    assert store.versions("silver", "t") == again
    _merge(store, _rows(spark, [9], 10).withColumn("w", F.lit("new")))
    assert {r.k: (r.v, r.w) for r in store.read("silver", "t").filter("k IN (8, 9)").collect()} == {8: (9, None), 9: (10, "new")}


def test_an_unmarked_merge_is_not_read(spark, tmpdir_path):
    import os
    store = TableStore(spark, tmpdir_path)
    _merge(store, _rows(spark, [1, 2], 1))
    _merge(store, _rows(spark, [1], 2))
    os.remove(f"{tmpdir_path}/silver/t/version=0000000002/_SUCCESS")  # as a lost job leaves it
    assert _got(store) == [(1, 1), (2, 1)]
    _merge(store, _rows(spark, [2], 3))
    assert _got(store) == [(1, 1), (2, 3)]
