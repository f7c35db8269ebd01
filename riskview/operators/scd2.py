"""Type-2 slowly changing dimension history without MERGE.

A history holds every version with ``effective_from``, ``effective_to`` and
``is_current``.  An incoming batch has one row per key.  Per key:  not in the
batch -> current row kept;  new key -> inserted;  tracked attributes equal
(NULL-safe) -> current row kept (untracked changes do not open a version);
otherwise the current row is closed at ``run_ts`` and the incoming row opens a
version at ``run_ts``.

Re-runs.  Applying a batch at the ``run_ts`` of versions that the history
already holds first undoes that run, so a corrected batch replaces the earlier
one and no version of zero length arises.  A history that has moved past
``run_ts`` raises.  Rows without a key never enter a history: ``null_key_rows``
gives them for reporting.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.config import OPEN_END
from riskview.operators.joins import fits

TRIPLE = ("effective_from", "effective_to", "is_current")


def _ts(run_ts: Column | str) -> Column:
    return F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def _no_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that no history takes, because a key column is NULL."""
    return df.filter(~_no_null(keys))


def keyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that a history takes: no key column is NULL."""
    return df.filter(_no_null(keys))


def key_part(key: Column, parts: int) -> Column:
    """Which of ``parts`` parts a key (a struct of the key columns, in the
    history's types) lies in."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def scd2_initial(incoming: DataFrame, run_ts: Column | str) -> DataFrame:
    """First load: every incoming row becomes the open, current version."""
    return incoming.withColumns({"effective_from": _ts(run_ts),
                                 "effective_to": open_end(),
                                 "is_current": F.lit(True)})


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current"))


def expired_rows(history: DataFrame) -> DataFrame:
    return history.filter(~F.col("is_current"))


def _changed(old: str, new: str, tracked: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b,
                  [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in tracked])


def scd2_changed_keys(history: DataFrame, incoming: DataFrame,
                      keys: Sequence[str], tracked: Sequence[str],
                      broadcast_max_rows: int | None = None) -> DataFrame:
    """Keys present on both sides whose tracked attributes differ NULL-safely.
    A batch proven to hold at most ``broadcast_max_rows`` rows is broadcast,
    so the current rows are matched where they are read."""
    o = current_rows(history).select(*keys, F.struct(*tracked).alias("__o"))
    n = incoming.select(*keys, F.struct(*tracked).alias("__n"))
    if broadcast_max_rows is not None and fits(incoming, broadcast_max_rows):
        n = F.broadcast(n)
    return (o.join(n, list(keys)).filter(_changed("__o", "__n", tracked))
            .select(*keys))


def undo_run(history: DataFrame, run_ts: Column | str) -> DataFrame:
    """The history as it stood before ``run_ts``: versions that run opened go,
    versions it closed are open again.  Rows dated after it raise."""
    ts = _ts(run_ts)
    moved_on = (F.col("effective_from") > ts) | (~F.col("is_current") & (F.col("effective_to") > ts))
    checked = F.when(moved_on, F.raise_error(F.lit("the history has moved past this run"))
                     .cast("timestamp")).otherwise(F.col("effective_from"))
    closed_then = ~F.col("is_current") & (F.col("effective_to") == ts)
    kept = history.withColumn("effective_from", checked).filter(F.col("effective_from") < ts)
    return kept.withColumns({
        "effective_to": F.when(closed_then, open_end()).otherwise(F.col("effective_to")),
        "is_current": F.col("is_current") | closed_then})


def scd2_apply(history: DataFrame, incoming: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], run_ts: Column | str,
               broadcast_max_rows: int | None = None) -> DataFrame:
    """All versions after applying ``incoming`` (one row per key) at ``run_ts``.

    By default the current rows and the batch meet in one full outer join on
    the key (one shuffle of each side).  With ``broadcast_max_rows``, a batch
    proven (a count that moves no rows) to hold at most that many rows has its keys
    broadcast instead: the current rows split map-side into untouched ones
    (anti join, passed through) and touched ones (semi join), and only the
    touched rows meet the batch in the full outer join.  The current table -
    the large side - is then scanned but never shuffled.  A larger batch
    takes the shuffled plan; the result is the same either way.
    """
    ts = _ts(run_ts)
    cols = history.columns
    schema = {f.name: f.dataType for f in history.schema.fields}
    data_cols = [c for c in cols if c not in TRIPLE]
    inc_cols = set(incoming.columns)
    incoming = incoming.filter(_no_null(keys))
    history = undo_run(history, ts)

    cur, untouched = current_rows(history), None
    if broadcast_max_rows is not None and fits(incoming, broadcast_max_rows):
        batch_keys = F.broadcast(incoming.select(*keys))
        untouched = cur.join(batch_keys, list(keys), "left_anti")
        cur = cur.join(batch_keys, list(keys), "left_semi")

    o = cur.select(*keys, F.struct(*cols).alias("__o"))
    n = incoming.select(
        *keys,
        F.struct(*[(F.col(c) if c in inc_cols else F.lit(None)).cast(schema[c]).alias(c)
                   for c in data_cols]).alias("__n"))
    j = o.join(n, list(keys), "full_outer")

    opened = F.struct(*[F.col(f"__n.{c}").alias(c) for c in data_cols],
                      ts.alias("effective_from"), open_end().alias("effective_to"),
                      F.lit(True).alias("is_current"))
    closed = (F.col("__o").withField("effective_to", ts)
              .withField("is_current", F.lit(False)))
    versions = (F.when(F.col("__n").isNull(), F.array(F.col("__o")))
                .when(F.col("__o").isNull(), F.array(opened))
                .when(_changed("__o", "__n", tracked), F.array(closed, opened))
                .otherwise(F.array(F.col("__o"))))
    touched = j.select(F.inline(versions))
    if untouched is not None:
        touched = touched.unionByName(untouched)
    return touched.unionByName(expired_rows(history))


# A history as changes: rows ``opened`` hold a version without its end, rows
# ``closed`` only the key, start and end of a version (``__k`` and the times).

def as_changes(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions of a first load as ``opened`` rows."""
    return (history.filter(_no_null(keys)).drop("is_current")
            .withColumns({"effective_to": F.lit(None).cast("timestamp"),
                          "__k": F.struct(*keys), "change": F.lit("opened")}))


def from_changes(rows: DataFrame) -> DataFrame:
    """The history that a set of changes makes."""
    opened = rows.filter(F.col("change") == "opened").drop("change", "effective_to")
    closed = rows.filter(F.col("change") == "closed").select(
        "__k", "effective_from", F.col("effective_to").alias("__end"))
    out = opened.join(closed, ["__k", "effective_from"], "left")
    return (out.withColumns({"effective_to": F.coalesce("__end", open_end()),
                             "is_current": F.col("__end").isNull()})
            .select(*[c for c in opened.columns if c not in ("__k", "effective_from")], *TRIPLE))


def scd2_changes(history: DataFrame, incoming: DataFrame, keys: Sequence[str],
                 tracked: Sequence[str], run_ts: Column | str,
                 broadcast_max_rows: int | None = None) -> DataFrame:
    """What ``incoming`` opens and closes at ``run_ts`` in a history of earlier
    runs; rows that stay as they are do not appear.

    A batch proven to hold at most ``broadcast_max_rows`` rows sends its keys
    to the current rows first, so only the touched ones are shuffled.
    """
    ts = _ts(run_ts)
    data_cols = [c for c in history.columns if c not in TRIPLE]
    schema = {f.name: f.dataType for f in history.schema.fields}
    incoming = incoming.filter(_no_null(keys))
    cur = current_rows(history).select(*data_cols, "effective_from")
    if broadcast_max_rows is not None and fits(incoming, broadcast_max_rows):
        cur = cur.join(F.broadcast(incoming.select(*keys)), list(keys), "left_semi")
    o = cur.select(*keys, F.struct(*tracked, "effective_from").alias("__o"))
    n = incoming.select(*keys, F.struct(*[
        (F.col(c) if c in incoming.columns else F.lit(None)).cast(schema[c]).alias(c)
        for c in data_cols]).alias("__n"))
    j = n.join(o, list(keys), "left")

    def change(kind: str, start: Column, end: Column, data: bool) -> Column:
        cells = [(F.col(f"__n.{c}") if data or c in keys else F.lit(None)).cast(schema[c]).alias(c)
                 for c in data_cols]
        return F.struct(*cells, start.alias("effective_from"), end.cast("timestamp").alias("effective_to"),
                        F.struct(*[F.col(f"__n.{k}").alias(k) for k in keys]).alias("__k"),
                        F.lit(kind).alias("change"))
    opened = change("opened", ts, F.lit(None), True)
    closed = change("closed", F.col("__o.effective_from"), ts, False)
    rows = (F.when(F.col("__o").isNull(), F.array(opened))
            .when(_changed("__o", "__n", tracked), F.array(opened, closed))
            .otherwise(F.array().cast(_array_of(j, opened))))
    return j.select(F.inline(rows))


def _array_of(df: DataFrame, cell: Column):
    from pyspark.sql import types as T
    return T.ArrayType(df.select(cell.alias("c")).schema["c"].dataType)


def scd2_summary(history: DataFrame) -> DataFrame:
    """One row: total, current and expired version counts (one pass)."""
    return history.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col("is_current")).alias("current"),
                       F.count_if(~F.col("is_current")).alias("expired"))
