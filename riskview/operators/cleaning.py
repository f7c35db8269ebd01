"""Cleaning operators: PII masking and latest-row-per-key deduplication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskview.functions.masking import DEFAULT_MASKS


def mask_columns(df: DataFrame,
                 masks: Mapping[str, Callable[[Column], Column]] = DEFAULT_MASKS
                 ) -> DataFrame:
    """Replace each named column by its masked value, in place (same name,
    same position).  Columns absent from ``df`` are skipped."""
    present = {c: fn(F.col(c)) for c, fn in masks.items() if c in df.columns}
    return df.withColumns(present)


def mask_customer_pii(df: DataFrame) -> DataFrame:
    """SSN to last four, date of birth to the year, e-mail local part hidden."""
    return mask_columns(df, DEFAULT_MASKS)


def _sort_expr(o: Column | str | tuple[str, bool]) -> Column:
    if isinstance(o, tuple):
        name, ascending = o
        return F.col(name).asc_nulls_last() if ascending else F.col(name).desc_nulls_last()
    if isinstance(o, str):
        return F.col(o).desc_nulls_last()
    return o


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 order: Sequence[Column | str | tuple[str, bool]]) -> DataFrame:
    """Keep the first row per key under ``order`` (plain names sort descending).

    Written as ``row_number() == 1`` so Catalyst plans a partial
    ``WindowGroupLimit`` *before* the shuffle: each map task keeps one row per
    key, so a key holding a third of the rows still ships one row per task.
    ``order`` should end in a unique column to make the winner deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*[_sort_expr(o) for o in order])
    rn = "__rv_rn"
    return (df.withColumn(rn, F.row_number().over(w))
            .filter(F.col(rn) == 1).drop(rn))


def latest_per_customer(docs: DataFrame, date_col: str = "verification_date",
                        id_col: str = "doc_id") -> DataFrame:
    """Most recent document per customer (ties broken by the larger id)."""
    return dedup_latest(docs, ["customer_id"], [date_col, id_col])


def most_recent_account(activity: DataFrame) -> DataFrame:
    """One account per customer: the most recently active one (fewest days
    since activity, then the smallest account id)."""
    return dedup_latest(activity, ["customer_id"],
                        [("days_since_activity", True), ("account_id", True)])
