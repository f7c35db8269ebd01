"""Point-in-time join: every fact row with the version valid at its time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _month(t: Column) -> Column:
    return F.date_trunc("month", t)


def as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], time: str, start: str,
          bucket: Callable[[Column], Column] = _month) -> DataFrame:
    """``facts`` with the columns of the key's last version that began at or
    before ``time`` (NULL where none had begun).

    No row meets a range of others.  Time is cut into buckets: the last version
    of each key and bucket is carried to the key's later buckets (a window over
    its buckets, so over the calendar, not over its rows), and within a key and
    bucket one pass in time order hands each fact the version before it.  The
    work is linear in facts and versions, and a key with very many rows is
    spread over its buckets; a finer ``bucket`` spreads it further.

    ``start`` is unique within a key; a version that begins at a fact's very
    time is valid for it.  Rows with a NULL key or time have no version.
    """
    keys, payload = list(keys), [c for c in versions.columns if c not in keys]
    v = (versions.where(F.col(start).isNotNull())
         .select(*keys, F.col(start).cast("timestamp").alias("__t"), F.struct(*payload).alias("__v")))
    v = v.withColumn("__b", bucket(F.col("__t")))
    f = facts.select(*keys, F.col(time).cast("timestamp").alias("__t"), F.struct(*facts.columns).alias("__f"))
    f = f.withColumn("__b", bucket(F.col("__t")))
    ends = v.groupBy(*keys, "__b").agg(F.max_by("__v", "__t").alias("__last"))
    wanted = f.select(*keys, "__b", F.lit(None).cast(ends.schema["__last"].dataType).alias("__last")).distinct()
    marks = ends.unionByName(wanted).groupBy(*keys, "__b").agg(F.first("__last", ignorenulls=True).alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("__v", F.last("__last", ignorenulls=True).over(before)).where(F.col("__v").isNotNull())
    # in time order: what is carried in, then versions before the facts of the same time
    none_f, none_v = F.lit(None).cast(f.schema["__f"].dataType), F.lit(None).cast(v.schema["__v"].dataType)
    rows = (carried.select(*keys, "__b", F.lit(None).cast("timestamp").alias("__t"), F.lit(0).alias("__o"), "__v", none_f.alias("__f"))
            .union(v.select(*keys, "__b", "__t", F.lit(1), "__v", none_f))
            .union(f.select(*keys, "__b", "__t", F.lit(2), none_v, "__f")))
    known = F.col("__t").isNotNull()
    for k in keys:
        known &= F.col(k).isNotNull()
    order = Window.partitionBy(*keys, "__b").orderBy(F.col("__t").asc_nulls_first(), "__o").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__at", F.last("__v", ignorenulls=True).over(order)).where("__o = 2")
    at = F.when(known, F.col("__at"))
    return rows.select("__f.*", *[at[c].alias(c) for c in payload if c not in facts.columns])
