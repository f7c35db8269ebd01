import math

import numpy as np
import pytest

from riskview.llm.metric_join import Range, exact_cosine, near_vectors

SMALL = Range(cell=40, pivots=6, sample=200, block=16, chunk=2)


def brute(rows, least=0.95):
    """n_links and component of every row, pair by pair."""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    vecs = [np.array(v, dtype=np.float64) if usable(v) else None for _, v in rows]
    links = [[] for _ in rows]
    for i, x in enumerate(vecs):
        for j, y in enumerate(vecs[:i]):
            if x is not None and y is not None and exact_cosine(x, y) >= least:
                links[i].append(j)
                links[j].append(i)
    seen, out = {}, []
    for start in range(len(rows)):
        if start not in seen:
            todo, group = [start], {start}
            while todo:
                for j in links[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            ids = [rows[k][0] for k in group if rows[k][0] is not None]
            seen |= {k: min(ids, default=None) for k in group}
        out.append((rows[start][0], len(links[start]), seen[start]))
    return sorted(out, key=repr)


def run(spark, rows, how=SMALL, kind="float"):
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], f"vec_id long, embedding array<{kind}>, id int, cell string")
    got = near_vectors(df, how).collect()
    assert all(r["kept"] == (None if None in (r["vec_id"], r["component_id"]) else r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr)


def f32(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


def clustered(seed, groups, each, dim, spread):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(groups, dim))
    return [f32(h / np.linalg.norm(h) * rng.uniform(0.1, 9) + rng.normal(size=dim) * spread) for h in heads for _ in range(each)]


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_of_every_tightness(spark, seed):
    vecs = clustered(seed, 12, 15, 5, 0.02) + clustered(seed + 9, 8, 12, 5, 0.25) + clustered(seed + 5, 60, 1, 5, 0.1)
    rows = list(enumerate(vecs))
    assert run(spark, rows) == brute(rows)


def test_one_hot_group_and_copies(spark):
    rng = np.random.default_rng(3)
    vecs = [f32(np.r_[1, rng.normal(size=4) * 0.05]) for _ in range(120)]  # all linked, all different
    vecs += [f32(np.r_[1, rng.normal(size=4) * 0.4]) for _ in range(120)]  # a ring around them
    vecs += [f32([1, 2, 3, 4, 5])] * 40 + [f32([2, 4, 6, 8, 10])] * 3  # copies, and parallel ones
    rows = [(1000 - i, v) for i, v in enumerate(vecs)]
    assert run(spark, rows) == brute(rows)


def test_chain_over_cells(spark):
    """Neighbours on a circle are linked, others not: one component."""
    step = math.acos(0.95) * 0.7
    rows = [(i + 1, f32([math.cos(i * step / 1.0), math.sin(i * step), 0.3])) for i in range(25)]
    how = Range(cell=3, pivots=8, sample=200, block=4, chunk=1)
    assert run(spark, rows, how) == brute(rows)


def test_exactly_at_the_threshold(spark):
    """A cosine of 19/20 by whole numbers links, one a little below does not."""
    rows = [(1, [20.0, 0.0]), (2, [19.0, math.sqrt(39.0)]), (3, [0.0, 0.0, 20.0, 0.0]), (4, [0.0, 0.0, 18.999999, math.sqrt(39.0)])]
    assert run(spark, rows, kind="double") == brute(rows)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0, 0.0]), (2, None), (3, [math.nan, 1.0]), (4, [None, 1.0]), (5, []), (6, [0.0, 0.0]),
            (7, [math.inf]), (8, [-1.0, -2.0]), (9, [2.0, 4.0, 0.1]), (None, [1.0, 2.0]), (None, None), (None, [5.0, -1.0]),
            (0, [1.0, 2.0]), (11, [0.0]), (11, [0.0]), (12, [1e-30, 2e-30]), (13, [1e30, 2e30])]
    assert run(spark, rows) == brute(rows)
    big = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1.0, 0.0])]
    assert run(spark, big, kind="double") == brute(big)


def test_same_id_on_different_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])]
    assert run(spark, rows) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


def test_parameters_do_not_change_results(spark):
    vecs = clustered(7, 30, 6, 16, 0.04)
    rows = list(enumerate(vecs))
    want = brute(rows)
    assert run(spark, rows, Range()) == want
    assert run(spark, rows, Range(cell=5, pivots=3, sample=20, levels=4, block=8, chunk=3)) == want
