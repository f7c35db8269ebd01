"""Layered tables: plain Parquet directories written by Spark's own writers.

* Bronze and the fact: Hive-partitioned by day; a run replaces only its own
  day (dynamic partition overwrite).
* Snapshots (silver, gold, dimensions): ``<table>/version=<n>/``, a directory
  a publish.  Readers take the highest one that Spark has marked complete
  (``_SUCCESS``), so a table may be read and published in one plan and a lost
  job leaves nothing that is read.
* Merged snapshots (silver of a stream): a version holds only the key parts
  that the batch touched, ``version=<n>/whole=<0|1>/key_parts=<n>/key_part=<i>/``;
  readers take each part from the newest version that has it, back to the
  last whole one.  Every ``whole_every``-th merge, and one that finds its parts
  grown to twice their size, writes all parts.
* SCD2 history: ``<table>/run=<stamp>/change=opened|closed/``, a directory a
  run, holding only what the run changed: the versions it opened, and for the
  versions it closed their key, start and end.  Nothing is ever rewritten; a
  re-run of the same run replaces its own directory only.  Below that the rows
  lie by a hash of their key (``key_parts=<n>/key_part=<i>``), so a batch reads
  only the parts that hold its keys.  The first load sets the number of parts
  from its rows; it stays for the life of the table.

Snapshots older than the last whole one are left to the storage's retention
rule.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskview.operators import scd2


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df`` (others are kept)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def run_stamp(run_ts: str) -> str:
    """A run timestamp as a directory name that sorts in time order."""
    return dt.datetime.fromisoformat(run_ts).strftime("%Y%m%dT%H%M%S")


class OlderRunError(ValueError):
    """A history run dated before one that is already applied."""


class TableStore:
    """Snapshots and histories under ``<base>/<layer>/<table>``.

    ``part_rows``: rows that make one key part of a history's first load or
    of a merged snapshot; ``whole_every``: merges until one writes all parts.
    """

    def __init__(self, spark: SparkSession, base: str, part_rows: int = 5_000_000, whole_every: int = 50):
        self.spark = spark
        self.base = base.rstrip("/")
        self.part_rows = part_rows
        self.whole_every = whole_every

    def table_dir(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"

    def _complete(self, layer: str, table: str, prefix: str) -> list[str]:
        """Names after ``prefix`` of the table's complete directories, in
        order.  Listing errors propagate: a failure must not pass for an
        absent table and start its history anew."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = path(self.table_dir(layer, table))
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        return sorted(n[len(prefix):] for n in names
                      if n.startswith(prefix) and fs.exists(path(root, f"{n}/_SUCCESS")))

    def _named(self, directory: str, prefix: str) -> list[str]:
        """Names after ``prefix`` of what lies in a directory."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return [n[len(prefix):] for n in names if n.startswith(prefix)]

    def _filled(self, layer: str, table: str, before: str | None) -> list[str]:
        """Directories of the runs (before one) that changed anything: their
        ``change=`` partitions exist."""
        root = self.table_dir(layer, table)
        dirs = [f"{root}/run={r}" for r in self.runs(layer, table) if before is None or r < before]
        return [d for d in dirs if self._named(d, "change=")]

    # ------------------------------------------------------------- snapshots
    def versions(self, layer: str, table: str) -> list[str]:
        return self._complete(layer, table, "version=")

    def runs(self, layer: str, table: str) -> list[str]:
        return self._complete(layer, table, "run=")

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.versions(layer, table) or self.runs(layer, table))

    def _next(self, layer: str, table: str) -> str:
        last = self.versions(layer, table)
        return f"{self.table_dir(layer, table)}/version={int(last[-1]) + 1 if last else 1:010d}"

    def publish(self, df: DataFrame, layer: str, table: str,
                partition_by: Sequence[str] = ()) -> None:
        """Replace the table's contents with ``df`` (its schema may change)."""
        # overwrite: a lost attempt may have left parts there (static mode, as
        # dynamic overwrite leaves no completion mark)
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self._next(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        """The latest snapshot, or all versions of a history."""
        last = self.versions(layer, table)
        if last:
            merged = self._merged(layer, table)
            if merged:
                return self._read_parts(layer, table, merged[1].values())
            return self.spark.read.parquet(f"{self.table_dir(layer, table)}/version={last[-1]}")
        history = self.history(layer, table)
        if history is not None:
            return history
        raise FileNotFoundError(f"no published table {layer}/{table}")

    # ------------------------------------------------------- merged snapshots
    def _merged(self, layer: str, table: str) -> tuple[int, dict[int, str], int] | None:
        """Of a merged snapshot: the number of key parts, the newest directory
        of each, and how many versions they come from."""
        parts, dirs, seen = 0, {}, 0
        for v in reversed(self.versions(layer, table)):
            version = f"{self.table_dir(layer, table)}/version={v}"
            whole = self._named(version, "whole=")
            if not whole:
                break
            seen += 1
            count = self._named(f"{version}/whole={whole[0]}", "key_parts=")[0]
            parts, held = int(count), f"{version}/whole={whole[0]}/key_parts={count}"
            for i in self._named(held, "key_part="):
                dirs.setdefault(int(i), f"{held}/key_part={i}")
            if whole[0] == "1":
                break
        return (parts, dirs, seen) if dirs else None

    def _read_parts(self, layer: str, table: str, dirs) -> DataFrame:
        dirs = sorted(dirs)  # versions are numbered in order: the newest is last
        base = self.table_dir(layer, table)
        newest = self.spark.read.option("basePath", base).parquet(dirs[-1])
        rows = self.spark.read.schema(newest.schema).option("basePath", base).parquet(*dirs)
        return rows.drop("version", "whole", "key_parts", "key_part")

    def merge(self, rows: DataFrame, layer: str, table: str, keys: Sequence[str],
              combine: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()) -> None:
        """Merge new rows into a snapshot: ``combine`` makes the new contents
        of a part from its stored and its new rows, and depends on rows of
        equal ``keys`` only.  Stored columns that the new rows lack go;
        columns that only they have are NULL on stored rows.

        Only key parts that ``rows`` has keys of are read and written.  The
        same rows again give the same contents; no rows change nothing."""
        merged = self._merged(layer, table)
        stored, whole = None, True
        if merged:
            parts, dirs, seen = merged
            types = dict(self._read_parts(layer, table, dirs.values()).dtypes)
            key = F.struct(*[F.col(k).cast(types[k]).alias(k) for k in keys])
            touched = {r.p for r in rows.select(scd2.key_part(key, parts).alias("p")).distinct().collect()}
            if not touched:
                return
            held = [d for i, d in dirs.items() if i in touched]
            each = self._read_parts(layer, table, held).count() / len(held) if held else 0
            whole = each > 2 * self.part_rows or seen >= self.whole_every
            if each > 2 * self.part_rows:
                parts *= math.ceil(each / self.part_rows)
            read = dirs.values() if whole else held
            stored = self._read_parts(layer, table, read) if read else None
        else:
            if self.versions(layer, table):
                stored = self.read(layer, table)
            count = rows.count() + (stored.count() if stored is not None else 0)
            if not count:  # a table without rows has no parts
                self.publish(combine(rows), layer, table, partition_by)
                return
            parts = max(1, math.ceil(count / self.part_rows))
            types = dict((rows if stored is None else stored).dtypes)
            key = F.struct(*[F.col(k).cast(types[k]).alias(k) for k in keys])
        if stored is not None:
            stored = stored.select(*[c for c in stored.columns if c in rows.columns])
            rows = stored.unionByName(rows, allowMissingColumns=True)
        out = combine(rows).withColumns({"whole": F.lit(int(whole)), "key_parts": F.lit(parts), "key_part": scd2.key_part(key, parts)})
        by = ["whole", "key_parts", "key_part", *partition_by]
        (out.hint("rebalance", F.col("key_part")).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*by).parquet(self._next(layer, table)))

    # --------------------------------------------------------------- history
    def history(self, layer: str, table: str, before: str | None = None,
                key_parts: Sequence[int] | None = None) -> DataFrame | None:
        """All versions, with ``effective_to`` and ``is_current``; with
        ``before``, as they stood before that run (None if there were none);
        with ``key_parts``, only the versions in those parts, and no file of
        another part is opened.

        One scan of the opened versions and one of the closures.  A version
        has at most one closure, so the left join cannot fan out; closures
        hold keys and two timestamps only.
        """
        runs = self._filled(layer, table, before)
        if not runs:
            return None
        newest = self.spark.read.parquet(runs[-1])
        rows = (self.spark.read.schema(newest.schema).option("basePath", self.table_dir(layer, table))
                .parquet(*runs))
        if key_parts is not None:
            rows = rows.filter(F.col("key_part").isin(*key_parts))
        return scd2.from_changes(rows.drop("run", "key_parts", "key_part"))

    def _touched(self, incoming: DataFrame, history: DataFrame, keys: Sequence[str], parts: int) -> list[int]:
        """The key parts a batch has keys of (at most ``parts`` numbers)."""
        types = dict(history.dtypes)
        key = F.struct(*[F.col(k).cast(types[k]).alias(k) for k in keys])
        found = scd2.keyed_rows(incoming, keys).select(scd2.key_part(key, parts).alias("key_part")).distinct()
        return sorted(r.key_part for r in found.collect())

    def apply_scd2(self, incoming: DataFrame, layer: str, table: str,
                   keys: Sequence[str], tracked: Sequence[str], run_ts: str,
                   broadcast_max_rows: int | None = 1_000_000) -> None:
        """Apply one batch as the run ``run_ts``: write what it opens and
        closes against the history of the runs before it.

        A re-run replaces what the same run wrote, whatever the batch was
        then; a run older than one already applied is refused.  Only the key
        parts that the batch has keys of are read and written: a batch leaves
        rows with other keys as they are.
        """
        stamp = run_stamp(run_ts)
        later = [r for r in self.runs(layer, table) if r > stamp]
        if later:
            raise OlderRunError(f"{layer}/{table}: run {stamp} is older than run {later[-1]}")
        history = self.history(layer, table, before=stamp)
        if history is None:
            parts = max(1, math.ceil(incoming.count() / self.part_rows))
            changes = scd2.as_changes(scd2.scd2_initial(incoming, run_ts), keys)
        else:
            first = self._filled(layer, table, stamp)[0]
            change = self._named(first, "change=")[0]
            parts = int(self._named(f"{first}/change={change}", "key_parts=")[0])
            if parts > 1:
                history = self.history(layer, table, stamp, self._touched(incoming, history, keys, parts))
            changes = scd2.scd2_changes(history, incoming, keys, tracked, run_ts,
                                        broadcast_max_rows)
        changes = changes.withColumns({"key_parts": F.lit(parts), "key_part": scd2.key_part(F.col("__k"), parts)})
        # rebalanced by part, so the number of files follows the size of the change
        (changes.hint("rebalance", F.col("change"), F.col("key_part")).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("change", "key_parts", "key_part")
         .parquet(f"{self.table_dir(layer, table)}/run={stamp}"))
