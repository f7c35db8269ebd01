"""Lineage columns added on ingestion and on each layer hop.

Works the same on batch and streaming DataFrames.  The run timestamp is a
parameter (defaults to ``current_timestamp()``) so a run is reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts(run_ts: Column | str | None) -> Column:
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, str):
        return F.lit(run_ts).cast("timestamp")
    return run_ts


def date_parts(ts: Column, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_year": F.year(ts), f"{prefix}_month": F.month(ts),
            f"{prefix}_day": F.dayofmonth(ts)}


def with_ingest_metadata(df: DataFrame, pipeline: str,
                         run_ts: Column | str | None = None,
                         source_file: str | None = None,
                         file_column: bool = True) -> DataFrame:
    """Add ingestion_timestamp, source_file, pipeline, ingest_year/month/day.

    ``source_file=None`` takes the real file name from the scan's hidden
    ``_metadata`` column (per row, also in a stream); pass a literal when the
    input is not a plain file scan, or ``file_column=False`` to omit it.
    """
    ts = _ts(run_ts)
    cols: dict[str, Column] = {"ingestion_timestamp": ts}
    if file_column:
        cols["source_file"] = (F.lit(source_file) if source_file is not None
                               else F.col("_metadata.file_name"))
    cols["pipeline"] = F.lit(pipeline)
    cols.update(date_parts(ts, "ingest"))
    return df.withColumns(cols)


def with_layer_metadata(df: DataFrame, layer: str,
                        run_ts: Column | str | None = None) -> DataFrame:
    """Add ``<layer>_timestamp`` and ``<layer>_year/month/day``.

    Earlier layers' lineage columns are kept, not overwritten.
    """
    ts = _ts(run_ts)
    return df.withColumns({f"{layer}_timestamp": ts, **date_parts(ts, layer)})
