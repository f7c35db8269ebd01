"""SCD2 invariants over random batch sequences."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskview.operators import scd2

SCHEMA = "customer_id long, name string, segment string, phone string"
KEYS, TRACKED = ["customer_id"], ["segment", "phone"]

batch = st.dictionaries(st.integers(0, 5),
                        st.tuples(st.sampled_from(["n1", "n2"]),
                                  st.sampled_from(["A", "B"]),
                                  st.sampled_from([None, "p1"])),
                        max_size=6)


def _df(spark, b):
    return spark.createDataFrame([(k, *v) for k, v in sorted(b.items())] or None, SCHEMA) \
        if b else spark.createDataFrame([], SCHEMA)


def _run(spark, batches, broadcast_max_rows=None):
    hist = None
    for i, b in enumerate(batches):
        ts = f"2024-01-{i + 1:02d} 00:00:00"
        inc = _df(spark, b)
        hist = scd2.scd2_initial(inc, ts) if hist is None else \
            scd2.scd2_apply(hist, inc, KEYS, TRACKED, ts, broadcast_max_rows)
        hist = spark.createDataFrame(hist.collect(), hist.schema)  # cut lineage for the test
    return hist


@settings(max_examples=12, deadline=None)
@given(st.lists(batch, min_size=1, max_size=4))
def test_invariants(spark, batches):
    rows = _run(spark, batches).collect()
    # broadcasting the batch keys (any batch fits 6 rows; 3 splits the runs
    # between both plans) must not change a single version
    for limit in (6, 3):
        assert sorted(map(str, _run(spark, batches, limit).collect())) == \
            sorted(map(str, rows))
    by_key = {}
    for r in rows:
        by_key.setdefault(r.customer_id, []).append(r)
    last = {}
    for b in batches:
        last.update(b)
    for k, versions in by_key.items():
        versions.sort(key=lambda r: r.effective_from)
        assert sum(r.is_current for r in versions) == 1
        assert versions[-1].is_current
        for a, b in zip(versions, versions[1:]):
            assert a.effective_to == b.effective_from          # contiguous
            assert a.effective_from < a.effective_to
            assert (a.segment, a.phone) != (b.segment, b.phone)  # a version = a change
        cur = versions[-1]
        assert (cur.segment, cur.phone) == last[k][1:]
    assert set(by_key) == set(last)


def test_reapply_is_noop_and_history_only_grows(spark):
    b1 = {1: ("a", "A", None), 2: ("b", "B", "p1")}
    b2 = {1: ("a", "A", "p1"), 3: ("c", "A", None)}
    h1 = _run(spark, [b1])
    h2 = _run(spark, [b1, b2])
    h3 = _run(spark, [b1, b2, b2])
    assert sorted(map(str, h2.collect())) == sorted(map(str, h3.collect()))
    assert h2.count() >= h1.count()
    cur = {r.customer_id: r.phone for r in scd2.current_rows(h2).collect()}
    assert cur == {1: "p1", 2: "p1", 3: None}       # NULL -> value opens a version
    closed = scd2.expired_rows(h2).collect()
    assert [(r.customer_id, r.effective_to) for r in closed] == [(1, dt.datetime(2024, 1, 2))]


def test_untracked_change_opens_no_version(spark):
    h = _run(spark, [{1: ("old", "A", None)}, {1: ("new name", "A", None)}])
    assert h.count() == 1 and h.first().name == "old"


def test_changed_keys(spark):
    h = scd2.scd2_initial(_df(spark, {1: ("a", "A", None), 2: ("b", "B", None)}), "2024-01-01")
    inc = _df(spark, {1: ("a", "A", "x"), 2: ("z", "B", None), 3: ("c", "C", None)})
    assert [r.customer_id for r in scd2.scd2_changed_keys(h, inc, KEYS, TRACKED).collect()] == [1]
    small = scd2.scd2_changed_keys(h, inc, KEYS, TRACKED, broadcast_max_rows=10)
    assert [r.customer_id for r in small.collect()] == [1]
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_corrected_rerun_replaces_its_own_versions(spark):
    h1 = _run(spark, [{1: ("a", "A", None), 2: ("b", "B", None)}])
    wrong, right = {1: ("a", "X", None), 2: ("b", "B", None)}, {1: ("a", "A", None), 2: ("b", "Y", None)}
    ts = "2024-02-01 00:00:00"
    cut = lambda df: spark.createDataFrame(df.collect(), df.schema)
    once = cut(scd2.scd2_apply(h1, _df(spark, right), KEYS, TRACKED, ts))
    twice = cut(scd2.scd2_apply(cut(scd2.scd2_apply(h1, _df(spark, wrong), KEYS, TRACKED, ts)),
                                _df(spark, right), KEYS, TRACKED, ts))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
    assert all(r.effective_from < r.effective_to for r in twice.collect())


def test_older_run_raises(spark):
    import pytest
    h = _run(spark, [{1: ("a", "A", None)}, {1: ("a", "B", None)}])
    with pytest.raises(Exception, match="moved past"):
        scd2.scd2_apply(h, _df(spark, {1: ("a", "C", None)}), KEYS, TRACKED, "2024-01-01 12:00:00").collect()


def test_null_keys_never_enter_and_are_reported(spark):
    batch = spark.createDataFrame([(1, "a", "A", None), (None, "x", "A", None)], SCHEMA)
    h = scd2.scd2_initial(_df(spark, {1: ("a", "A", None)}), "2024-01-01")
    for day in ("02", "03", "04"):
        h = scd2.scd2_apply(h, batch, KEYS, TRACKED, f"2024-01-{day} 00:00:00")
    assert [r.customer_id for r in h.collect()] == [1]
    assert [r.name for r in scd2.null_key_rows(batch, KEYS).collect()] == ["x"]


def _stored(spark, path, batches, **how):
    from riskview.sources.store import TableStore
    store = TableStore(spark, path)
    for day, b in batches:
        store.apply_scd2(_df(spark, b), "silver", "c", KEYS, TRACKED, f"2024-01-{day:02d} 00:00:00", **how)
    return store


def test_stored_history_equals_the_algebra(spark, tmpdir_path):
    batches = [{k: ("n", "AB"[k % 2], None) for k in range(40)},
               {k: ("n", "C" if k % 3 == 0 else "AB"[k % 2], "p") for k in range(20, 60)},
               {k: ("n", "D" if k < 10 else "AB"[k % 2], None) for k in range(40)}]
    want = sorted(map(str, _run(spark, batches).collect()))
    for name, limit in (("shuffled", None), ("sent", 1000)):
        store = _stored(spark, f"{tmpdir_path}/{name}", list(enumerate(batches, 1)), broadcast_max_rows=limit)
        assert sorted(map(str, store.read("silver", "c").collect())) == want
    # before the third run, the history was that of the first two
    early = store.history("silver", "c", before="20240103T000000")
    assert sorted(map(str, early.collect())) == sorted(map(str, _run(spark, batches[:2]).collect()))


def test_store_rerun_and_older_run(spark, tmpdir_path):
    import pytest

    from riskview.sources.store import OlderRunError
    b1, wrong, right = {1: ("a", "A", None)}, {1: ("a", "X", None)}, {1: ("a", "B", None), 2: ("b", "B", None)}
    store = _stored(spark, tmpdir_path, [(1, b1), (2, wrong), (2, right)])
    assert sorted(map(str, store.read("silver", "c").collect())) == \
        sorted(map(str, _run(spark, [b1, right]).collect()))
    with pytest.raises(OlderRunError):
        _stored(spark, tmpdir_path, [(1, b1)])
    assert _stored(spark, tmpdir_path, [(2, right)]).read("silver", "c").count() == 3


def test_a_run_writes_only_what_it_changes(spark, tmpdir_path):
    """500 changed of 20,000 rows: 500 versions opened and 500 closed are
    written, in a few files, and no earlier file is touched."""
    import glob
    import os
    rows = spark.range(20_000).selectExpr("id AS customer_id", "'n' AS name", "'A' AS segment",
                                          "CAST(NULL AS STRING) AS phone")
    from riskview.sources.store import TableStore
    store = TableStore(spark, tmpdir_path)
    store.apply_scd2(rows, "silver", "c", KEYS, TRACKED, "2024-01-01")
    files = lambda run: glob.glob(f"{tmpdir_path}/silver/c/run={run}/**/*.parquet", recursive=True)
    first = {f: os.path.getmtime(f) for f in files("20240101T000000")}
    batch = rows.selectExpr("customer_id", "name", "IF(customer_id % 40 = 0, 'B', segment) AS segment", "phone")
    store.apply_scd2(batch, "silver", "c", KEYS, TRACKED, "2024-01-02", broadcast_max_rows=None)
    assert {f: os.path.getmtime(f) for f in files("20240101T000000")} == first
    written = spark.read.parquet(f"{tmpdir_path}/silver/c/run=20240102T000000")
    assert {r.change: r["count"] for r in written.groupBy("change").count().collect()} == {"opened": 500, "closed": 500}
    assert len(files("20240102T000000")) <= 4
    assert store.read("silver", "c").filter("is_current").count() == 20_000


def test_unmarked_directories_are_not_read(spark, tmpdir_path):
    import os
    store = _stored(spark, tmpdir_path, [(1, {1: ("a", "A", None)}), (2, {1: ("a", "B", None)})])
    os.remove(f"{tmpdir_path}/silver/c/run=20240102T000000/_SUCCESS")  # as a lost job leaves it
    assert [r.segment for r in store.read("silver", "c").collect()] == ["A"]


def _people(spark, ids, segment):
    return spark.createDataFrame([(i, f"n{i}", segment, None) for i in ids], SCHEMA)


def test_a_batch_reads_and_writes_only_the_parts_of_its_keys(spark, tmpdir_path):
    """With every file of the other parts broken, a batch still applies; a
    scan of the whole history does not."""
    import glob

    import pytest

    from riskview.sources.store import TableStore
    store = TableStore(spark, tmpdir_path, part_rows=100)
    store.apply_scd2(_people(spark, range(1, 801), "A"), "silver", "c", KEYS, TRACKED, "2024-01-01")
    root = f"{tmpdir_path}/silver/c"
    assert len(glob.glob(f"{root}/run=20240101T000000/change=opened/key_parts=8/key_part=*")) == 8
    store.apply_scd2(_people(spark, [7], "B"), "silver", "c", KEYS, TRACKED, "2024-01-02")
    hit = {p.rsplit("/", 1)[1] for p in glob.glob(f"{root}/run=20240102T000000/change=*/key_parts=8/key_part=*")}
    assert len(hit) == 1
    others = [f for f in glob.glob(f"{root}/run=20240101T000000/change=opened/key_parts=8/*/*.parquet") if f.split("/")[-2] not in hit]
    assert len(others) >= 7
    for f in others:
        crc = f.replace("part-", ".part-") + ".crc"
        for name in [f, *glob.glob(crc)]:
            with open(name, "wb") as out:
                out.write(b"broken")
    store.apply_scd2(_people(spark, [7], "C"), "silver", "c", KEYS, TRACKED, "2024-01-03")
    part = int(hit.pop().split("=")[1])
    seven = store.history("silver", "c", key_parts=[part]).filter("customer_id = 7")
    assert [(r.segment, r.is_current) for r in seven.orderBy("effective_from").collect()] == [("A", False), ("B", False), ("C", True)]
    with pytest.raises(Exception):
        store.history("silver", "c").collect()


def test_parts_do_not_change_a_history(spark, tmpdir_path):
    """Many parts, a key column of another type in a later batch, a re-run, an
    empty batch and keys that are new: as with one part."""
    from riskview.sources.store import TableStore
    got = []
    for rows in (1, 10_000):
        store = TableStore(spark, f"{tmpdir_path}/{rows}", part_rows=rows)
        apply = lambda df, day: store.apply_scd2(df, "silver", "c", KEYS, TRACKED, f"2024-01-{day:02d}")  # noqa: B023, E731
        apply(_people(spark, range(1, 13), "A"), 1)
        apply(_people(spark, [1, 2, 99], "X"), 2)
        apply(_people(spark, [2, 3, 50], "B").withColumn("customer_id", F.col("customer_id").cast("int")), 2)
        apply(_people(spark, [], "C"), 3)
        apply(_people(spark, [3, 4, 51], "D"), 4)
        got.append(sorted(map(str, store.read("silver", "c").collect())))
    assert got[0] == got[1] and len(got[0]) == 12 + 3 + 3
