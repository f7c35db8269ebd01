"""The deletion-neighbourhood fuzzy screen equals a brute-force scan."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskview.operators import screening


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _brute(names, listed, k):
    out = {}
    for cid, n in names:
        if n is None:
            continue
        cands = sorted((_lev(n, e), e) for e in set(listed) if e is not None and _lev(n, e) <= k)
        if cands:
            out[cid] = (cands[0][1], cands[0][0])
    return out


@pytest.mark.parametrize("k", [1, 2])
def test_fixed_cases(spark, k):
    names = [(1, "smith"), (2, "smyth"), (3, "smit"), (4, "jones"), (5, ""), (6, "a"), (7, None)]
    listed = ["smith", "jonas", "b", "smiths"]
    cust = spark.createDataFrame(names, "customer_id long, full_name string")
    wl = spark.createDataFrame([(i, e) for i, e in enumerate(listed)],
                               "watchlist_id long, entity_name string")
    got = {r.customer_id: (r.entity_name, r.distance)
           for r in screening.fuzzy_screen(cust, wl, k).collect()}
    assert got == _brute(names, listed, k)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=5), min_size=1, max_size=8),
       st.lists(st.text(alphabet="abc", max_size=5), min_size=1, max_size=5))
def test_random_equals_brute_force(spark, names, listed):
    rows = list(enumerate(names))
    cust = spark.createDataFrame(rows, "customer_id long, full_name string")
    wl = spark.createDataFrame(list(enumerate(listed)), "watchlist_id long, entity_name string")
    got = {r.customer_id: (r.entity_name, r.distance)
           for r in screening.fuzzy_screen(cust, wl, 1).collect()}
    assert got == _brute(rows, listed, 1)
