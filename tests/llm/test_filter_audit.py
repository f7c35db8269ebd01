import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from riskview.llm.filter_audit import Copy, audit, few_words, holds_any, many_capitals, repeated_words, shapley_matrix
from riskview.llm.queries import AUDITED
from tests.llm.helpers import AWKWARD, words


def fails(text, i, first):
    text = text or ""
    w = words(text)
    return {"A": len(w) < 4, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and first is not None and i > first}


SMALL = {"A": few_words(4), "B": repeated_words(50), "C": many_capitals(2), "D": holds_any("#$%&*|"), "E": Copy()}


def brute(rows, labels, letters="ABCDE"):
    """All orders, row by row."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    mark = {k: (max(q == 1 for j, q, _ in labels if j == k), max(t == 1 for j, _, t in labels if j == k)) for k, _, _ in labels}
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(fails(t, i, first.get(t or "")), mark.get(i, (0, 0))) for i, t, p in rows if (p or "") == part]
        total = dict.fromkeys(letters, 0)
        for order in permutations(letters):
            left = own
            for k, f in enumerate(order):
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                total[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(x[0][f] for x in own) - len(gone),
                    sum(x[0][f] and not any(x[0][g] for g in letters if g != f) for x in own),
                    sum(x[1][0] for x in gone), sum(x[1][1] for x in gone), f]
        for key, v in out.items():
            if key[0] == part:
                v[6] = total[v[6]]
    return {k: tuple(v) for k, v in out.items()}


def run(spark, rows, labels, filters=SMALL):
    docs = spark.createDataFrame([(i, t, p, "x", 1) for i, t, p in rows], "doc_id long, text string, source string, id string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, good int, toxic int")
    out = audit(docs, filters, F.col("source"), marks, ("good", "toxic")).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in out}


TEXTS = [*AWKWARD[:6], "a a a a a a b", "# x", "one two three four five", "ONE TWO THREE", "ONE TWO $ THREE", "x x x x X X #"]


def test_against_all_orders(spark):
    rows = [(i, t, ("web", "", None, "book")[i % 4]) for i, t in enumerate(TEXTS * 6)]
    rows += [(7, "ONE TWO THREE", "web"), (7, "ONE TWO THREE", "web"), (None, "# x", "web"), (None, None, "none")]
    labels = [(i, i % 3 - 1, int(i % 2 == 0)) for i in range(0, 60)] + [(4, 1, None), (999, 1, 1), (None, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, [x for x in labels if x[0] is not None])


def test_one_text_over_all_rows(spark):
    """A group of copies over several parts: one row in the table is no copy."""
    rows = [(1000 - i, "the same five words here", ("a", "b")[i % 2]) for i in range(400)]
    got = run(spark, rows, [])
    assert got == brute(rows, [])
    assert got["a", "EABCD", 1][:2] == (0, 200) and got["b", "EABCD", 1][:2] == (1, 199)


def test_empty_table_and_no_labels(spark):
    assert run(spark, [], []) == {}


@pytest.mark.parametrize("filters", [{"A": few_words(4)}, {"C": many_capitals(2), "D": holds_any("#$%&*|")}])
def test_other_sets_of_filters(spark, filters):
    rows = [(i, t, "p") for i, t in enumerate(TEXTS)]
    assert run(spark, rows, [], filters) == brute(rows, [], "".join(filters))


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_shares_are_the_mean_over_orders(n):
    """The least squares solution is what the definition over orders gives."""
    want = [[Fraction(0)] * (1 << n) for _ in range(n)]
    for order in permutations(range(n)):
        before = 0
        for i in order:
            want[i][before | 1 << i] += Fraction(1, factorial(n))
            want[i][before] -= Fraction(1, factorial(n))
            before |= 1 << i
    assert shapley_matrix(n) == want


def test_query_uses_the_stated_filters():
    assert list(AUDITED) == list("ABCDE")
