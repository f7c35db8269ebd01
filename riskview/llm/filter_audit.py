"""Audit of how text filters interact: exact Shapley shares and step counts.

A coalition is a set of filters applied together; its value is the number of
rows that at least one of them removes.  With ``n`` filters the values of all
``2 ** n`` coalitions say everything about every order of applying them:

* a step of an order removes ``v(before + filter) - v(before)`` rows;
* a filter's Shapley share is the solution of a least squares problem: fit the
  values by one number a filter, every coalition weighted by the Shapley
  kernel, under the constraint that the numbers add up to the value of all
  filters (efficiency).  The normal equations are solved in rationals, so the
  shares are exact.

Plan.  Failures are native expressions over whole texts, packed into a mask a
row.  Copies are found by a digest of the text: rows are first reduced to one a
(digest, part, id), so a hot text costs one row a task and id, then to one a
(digest, part); only these meet the digest's smallest id.  What is left is one
row for each part and mask, and the coalitions are sums over at most ``2 ** n``
masks.  The equations are the same for every part, so they are solved once, for
each unit vector of values, and applied as whole numbers over one denominator.

Cases: a null text counts as empty; a null part as the empty string; equal
texts with equal ids are no copies of each other, nor of a row with a null id,
which itself is never a copy; of several labels of one id the largest counts;
rows without a label count as neither; a failure condition that is null does
not fail; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import permutations
from math import comb, factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import once, stored


def few_words(least: int):
    """Fails texts of fewer than ``least`` words."""
    return lambda text, words: F.size(words) < least


def repeated_words(percent: int):
    """Fails texts whose distinct words are under ``percent`` per cent of their words."""
    return lambda text, words: 100 * F.size(F.array_distinct(words)) < percent * F.size(words)


def many_capitals(percent: int):
    """Fails texts with more than ``percent`` per cent of A-Z among their code points."""
    return lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > percent * F.length(text)


def holds_any(characters: str):
    """Fails texts that hold one of the characters of a class."""
    return lambda text, words: text.rlike(f"[{characters}]")


@dataclass(frozen=True)
class Copy:
    """Fails texts identical to the text of a row with a smaller id."""


def shapley_matrix(n: int) -> list[list[Fraction]]:
    """Row ``i``: how the values of all coalitions (by bit mask) make up the
    share of filter ``i``.

    Solves, for every unit vector of values, the normal equations of the
    kernel-weighted least squares with one multiplier for efficiency.
    """
    if n == 1:
        return [[Fraction(-1), Fraction(1)]]
    full = (1 << n) - 1
    weight = [Fraction(0)] * (full + 1)
    for mask in range(1, full):
        k = mask.bit_count()
        weight[mask] = Fraction(n - 1, comb(n, k) * k * (n - k))
    held = [[mask >> i & 1 for i in range(n)] for mask in range(full + 1)]
    system = [[2 * sum(w * h[i] * h[j] for w, h in zip(weight, held)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    system.append([Fraction(1)] * n + [Fraction(0)])
    sides = []
    for mask in range(full + 1):
        # the value of no filter is taken off every other one
        if mask == 0:
            rhs = [-2 * sum(w * h[i] for w, h in zip(weight, held)) for i in range(n)] + [Fraction(-1)]
        else:
            rhs = [2 * weight[mask] * held[mask][i] for i in range(n)] + [Fraction(int(mask == full))]
        sides.append(rhs)
    solved = _solve(system, sides)
    return [[solved[mask][i] for mask in range(full + 1)] for i in range(n)]


def _solve(system: list[list[Fraction]], sides: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss-Jordan elimination in rationals, for several right-hand sides."""
    size = len(system)
    rows = [[*map(Fraction, own), *(Fraction(s[i]) for s in sides)] for i, own in enumerate(system)]
    for col in range(size):
        pivot = next(r for r in range(col, size) if rows[r][col])
        rows[col], rows[pivot] = rows[pivot], rows[col]
        top = rows[col][col]
        rows[col] = [x / top for x in rows[col]]
        for r in range(size):
            if r != col and rows[r][col]:
                by = rows[r][col]
                rows[r] = [x - by * y for x, y in zip(rows[r], rows[col])]
    return [[rows[i][size + k] for i in range(size)] for k in range(len(sides))]


def failures(docs: DataFrame, filters: Mapping[str, object], part: Column, id_col: str, text_col: str) -> DataFrame:
    """id, part, digest of the text and mask of the filters failed, but copies."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def mask(words: Column) -> Column:
        bits = [F.when(test(F.col("text"), words), 1 << i).otherwise(0)
                for i, test in enumerate(filters.values()) if not isinstance(test, Copy)]
        return sum(bits, F.lit(0))

    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    return rows.select("id", "part", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"), once(words, mask).alias("mask"))


def _masked(rows: DataFrame, marks: DataFrame | None, filters: Mapping[str, object], names: list[str]) -> DataFrame:
    """part, mask (copies included) and counts: n and one for each mark."""
    counts = ["n", *names]
    if marks is None:
        rows = rows.select("*", *[F.lit(0).alias(c) for c in names])
    else:
        rows = rows.join(marks, "id", "left").na.fill(0, names)
    sums = [F.count("*").alias("n"), *[F.sum(c).cast("long").alias(c) for c in names]]
    copy = next((1 << i for i, test in enumerate(filters.values()) if isinstance(test, Copy)), None)
    if copy is None:
        return rows.groupBy("part", "mask").agg(*sums)
    # a text fixes its mask, so (digest, part, id) is what copies are told apart by
    each = rows.groupBy("digest", "part", "id", "mask").agg(*sums)
    held = F.struct(*counts)
    # of a digest and part: all rows, those of the smallest id, and those without an id
    own = each.groupBy("digest", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in counts], F.min("id").alias("least"), F.min_by(held, "id").alias("first"),
        *[F.sum(F.when(F.col("id").isNull(), F.col(c)).otherwise(0)).alias(f"{c}_none") for c in counts])
    own = stored(own, "texts")
    first = own.groupBy("digest").agg(F.min("least").alias("first_id"))
    own = own.join(first, "digest")

    def kept(c: str) -> Column:
        return F.col(f"{c}_none") + F.when(F.col("least") == F.col("first_id"), F.col("first")[c]).otherwise(0)

    both = own.select("part", F.explode(F.array(
        F.struct("mask", *[kept(c).alias(c) for c in counts]),
        F.struct((F.col("mask") + copy).alias("mask"), *[(F.col(c) - kept(c)).alias(c) for c in counts]))).alias("r"))
    return both.select("part", "r.*").where("n > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])


def coalitions(docs: DataFrame, filters: Mapping[str, object], part: Column, marks: DataFrame | None = None,
               names: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a part: rows in it, and for rows and each mark an array of what
    every coalition of filters (by bit mask) removes.  ``marks``: the id column
    and 0/1 columns ``names``."""
    names = list(names)
    if marks is not None:
        marks = marks.groupBy(F.col(id_col).cast("long").alias("id")).agg(
            *[F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(c) for c in names])
    rows = _masked(failures(docs, filters, part, id_col, text_col), marks, filters, names)
    # a part has at most one row a mask: 2 ** n small cells
    table = rows.groupBy("part").agg(F.sum("n").alias("rows"), F.collect_list(F.struct("mask", "n", *names)).alias("cells"))

    def removed(c: str) -> Column:
        none = F.lit(0).cast("long")
        return F.transform(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1)), lambda s: F.aggregate(
            "cells", none, lambda acc, r: acc + F.when(r["mask"].bitwiseAND(s) != 0, r[c]).otherwise(none)))

    return table.select("part", "rows", *[removed(c).alias(f"removed_{c}") for c in ("n", *names)])


def audit(docs: DataFrame, filters: Mapping[str, object], part: Column, marks: DataFrame | None = None,
          names: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a part, order of the filters and step: part, filter_order, step,
    kept, removed, redundant, unique_fails, ``<mark>_lost`` for each mark and
    shapley (the filter's removed rows, summed over all orders)."""
    letters, n = list(filters), len(filters)
    full = (1 << n) - 1
    table = stored(coalitions(docs, filters, part, marks, names, id_col, text_col), "coalitions")
    # shares as whole numbers: every order counts once
    shares = [[x * factorial(n) for x in row] for row in shapley_matrix(n)]
    scale = lcm(*(x.denominator for row in shares for x in row))
    v = F.col("removed_n")
    table = table.withColumn("shares", F.array(*[
        (sum((v[s] * int(x * scale) for s, x in enumerate(row) if x), F.lit(0)) / scale).cast("long") for row in shares]))
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, i in enumerate(order):
            steps.append(("".join(letters[j] for j in order), k + 1, i, before))
            before |= 1 << i
    # a fixed list of n * n! entries for every part, read from one literal
    plan = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","k":{k},"i":{i},"b":{b}}}' for o, k, i, b in steps) + "]"),
                       "array<struct<o:string,k:int,i:int,b:int>>")
    rows = table.select("*", F.explode(plan).alias("s")).select("*", "s.*")
    bit = F.expr("shiftleft(1, i)")
    after = F.col("b") + bit

    def value(of: str, mask: Column) -> Column:
        return F.element_at(of, (mask + 1).cast("int"))

    removed = value("removed_n", after) - value("removed_n", F.col("b"))
    return rows.select(
        "part", F.col("o").alias("filter_order"), F.col("k").alias("step"),
        (F.col("rows") - value("removed_n", after)).alias("kept"), removed.alias("removed"),
        (value("removed_n", bit) - removed).alias("redundant"),
        (value("removed_n", F.lit(full)) - value("removed_n", F.lit(full) - bit)).alias("unique_fails"),
        *[(value(f"removed_{c}", after) - value(f"removed_{c}", F.col("b"))).alias(f"{c}_lost") for c in names],
        F.element_at("shares", F.col("i") + 1).alias("shapley"))
