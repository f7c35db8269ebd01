"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows.

    An exact ``count()``: partial counts per task and one final sum, so no
    row leaves its task.  (``limit(n + 1).count()`` would stop scanning
    early, but it funnels up to ``n + 1`` rows of *every* partition into
    one task for the global limit - the whole input when it is large.)
    The callers count sides that are small, or computed anyway.
    """
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Mark ``df`` for broadcast only after proving it holds at most
    ``max_rows`` rows; otherwise return it unchanged and let the planner
    shuffle both sides.

    The proof is ``fits`` (a distributed count that moves no rows).  Use it
    for sides whose size is not known statically (derived dimensions,
    distinct names, a daily batch); published small tables are broadcast by
    the planner's own file-size statistics.
    """
    return F.broadcast(df) if fits(df, max_rows) else df
