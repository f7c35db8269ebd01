import math
import random
import re

import pytest

from riskview.llm.exact_topk import top_k


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    return sorted(out)


def run(spark, rows, k=5, every=10, **how):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, q int")
    return sorted(tuple(r) for r in top_k(df, k, every, **how).collect())


@pytest.mark.parametrize("slices", [1, 2, 3])
def test_against_brute_force(spark, slices):
    rng = random.Random(slices)
    rows = [(i, [round(rng.gauss(0, 1), 2) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(200)]  # one very common vector
    assert run(spark, rows, slices=slices, query_block=8, candidate_block=32) == brute(rows, 5, 10)


def test_large_query_sets_are_joined_by_block_and_salt(spark):
    rng = random.Random(7)
    rows = [(i, [round(rng.gauss(0, 1), 2) for _ in range(4)]) for i in range(400)] + [(1000 + i, [0.5] * 4) for i in range(100)]
    how = {"query_block": 16, "candidate_block": 16, "broadcast_bytes": 0, "salt_blocks": 3}
    assert run(spark, rows, **how) == brute(rows, 5, 10)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
        plan = top_k(df, 5, 10, **how)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert re.search(r"SortMergeJoin \[q#\d+L?, salt#\d+L?\]", plan)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (10, [1.0, -2.0, 3.0]), (20, None), (30, [math.nan]), (40, [None, 1.0]), (50, []),
            (None, [1.0]), (7, [math.inf]), (8, [1.0, 2.0]), (9, [-1.0])]
    assert run(spark, rows) == brute(rows, 5, 10)
    big = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0]), (3, [-3e6, 0.0])]
    assert run(spark, big) == brute(big, 5, 10)


def test_repeated_rows_count_each(spark):
    rows = [(0, [1.0])] * 2 + [(1, [2.0])] * 3 + [(2, [1.0])]
    assert [r[2] for r in run(spark, rows)] == [1, 1, 1, 2]


def test_empty_table(spark):
    assert run(spark, []) == []
