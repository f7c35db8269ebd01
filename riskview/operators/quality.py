"""Data-quality reports as DataFrames (nothing is printed).

Each report is one aggregation pass per table over its data; the column
contract compare is metadata only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class SchemaContractError(ValueError):
    pass


def layer_row_counts(tables: Mapping[str, DataFrame],
                     errors: Mapping[str, str] | None = None,
                     total: str | None = None) -> DataFrame:
    """``table_name, rows, columns, error`` for each table, all in one job;
    with ``total``, a last row of that name with the rows of all tables.

    ``errors`` names tables that could not be opened (e.g. not published
    yet); they are reported as rows with NULL counts and the message.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows",
                     F.lit(len(df.columns)).alias("columns"),
                     F.lit(None).cast("string").alias("error"))
             for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    if errors:
        spark = next(iter(tables.values())).sparkSession if tables else None
        bad = spark.createDataFrame(
            [(n, None, None, m) for n, m in errors.items()],
            "table_name string, rows long, columns int, error string")
        out = out.unionByName(bad)
    if total is not None:
        out = out.unionByName(out.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(
            F.lit(total).alias("table_name"), "rows", F.lit(None).cast("int").alias("columns"),
            F.lit(None).cast("string").alias("error")))
    return out


def schema_report(tables: Mapping[str, DataFrame],
                  contracts: Mapping[str, Sequence[str]],
                  strict: bool = False,
                  expected_types: Mapping[str, Mapping[str, str]] | None = None
                  ) -> DataFrame:
    """Per required column: ``table_name, column_name, present, null_count,
    table_passed``.  ``null_count`` is NULL for a missing column.

    ``expected_types`` (table -> column -> simple type name such as
    ``"bigint"``) also checks types: a column of another type counts as
    missing and the report gains ``actual_type``.
    ``strict=True`` raises ``SchemaContractError`` listing missing columns
    (the alert the contract is meant to raise) before any job runs.
    """
    def ok(t: str, c: str) -> bool:
        if c not in tables[t].columns:
            return False
        want = (expected_types or {}).get(t, {}).get(c)
        return want is None or tables[t].schema[c].dataType.simpleString() == want

    missing = {t: [c for c in cols if not ok(t, c)] for t, cols in contracts.items()}
    if strict and any(missing.values()):
        raise SchemaContractError(
            "; ".join(f"{t}: {', '.join(m)}" for t, m in missing.items() if m))
    parts = []
    for t, cols in contracts.items():
        df = tables[t]
        passed = not missing[t]
        present = [c for c in cols if c in df.columns]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present]
                        or [F.lit(0).alias("__rv_none")])
        extra = []
        if expected_types is not None:
            extra = ["actual_type"]
        cells = [F.struct(F.lit(c).alias("column_name"),
                          F.lit(ok(t, c)).alias("present"),
                          (F.col(c) if c in df.columns else F.lit(None))
                          .cast("long").alias("null_count"),
                          *([F.lit(df.schema[c].dataType.simpleString() if c in df.columns
                                   else None).cast("string").alias("actual_type")]
                            if extra else []))
                 for c in cols]
        parts.append(counts.select(F.inline(F.array(*cells)))
                     .select(F.lit(t).alias("table_name"), "column_name", "present",
                             "null_count", F.lit(passed).alias("table_passed"), *extra))
    return reduce(DataFrame.unionByName, parts)


def count_if_summary(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """One row: a total plus one conditional count per named predicate."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(F.expr(c) if isinstance(c, str) else c).alias(n)
                    for n, c in conditions.items()])
