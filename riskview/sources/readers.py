"""Typed landing readers: CSV, newline JSON, JSON arrays, Parquet.

Every reader takes the declared ``StructType`` (no inference pass) and finds
files at any depth below its path.  CSV columns are bound by the header's
names, whatever their order; a file whose header differs raises.  With
``keep_corrupt`` a record that cannot be parsed is kept as text in
``_corrupt_record`` instead of turning into a row of NULLs.

CSV and newline JSON split across tasks; a JSON array file is one task per
file (a multi-line document cannot be split), so producers should land many
moderate files rather than one large array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskview.schemas import SOURCE_FORMATS, SOURCES

CORRUPT = "_corrupt_record"


class HeaderError(ValueError):
    """A CSV header that does not hold exactly the declared columns."""


def _with_corrupt(schema: T.StructType, keep_corrupt: bool) -> T.StructType:
    if not keep_corrupt:
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def _reader(spark: SparkSession, schema: T.StructType, keep_corrupt: bool):
    r = (spark.read.schema(_with_corrupt(schema, keep_corrupt)).option("mode", "PERMISSIVE")
         .option("recursiveFileLookup", True))
    return r.option("columnNameOfCorruptRecord", CORRUPT) if keep_corrupt else r


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             keep_corrupt: bool = False) -> DataFrame:
    """Header CSV; quoted fields may hold commas and escaped quotes.

    The first line of one file gives the order of the columns (it reads that
    line only); Spark checks every other file's header against it.
    """
    named = (spark.read.option("header", True).option("recursiveFileLookup", True)
             .option("quote", '"').option("escape", '"').csv(path)).columns
    if sorted(named) != sorted(schema.names):
        raise HeaderError(f"{path}: header {named}, declared {schema.names}")
    order = T.StructType([schema[n] for n in named])
    df = (_reader(spark, order, keep_corrupt).option("header", True).option("enforceSchema", False)
          .option("quote", '"').option("escape", '"').csv(path))
    return df.select(*schema.names, *([CORRUPT] if keep_corrupt else []))


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType,
                keep_corrupt: bool = False) -> DataFrame:
    """One JSON object per line."""
    return _reader(spark, schema, keep_corrupt).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType,
                    keep_corrupt: bool = False) -> DataFrame:
    """Files each holding one JSON array of objects (``multiLine``).  A file
    that breaks off gives one record, its text, in ``_corrupt_record``."""
    return _reader(spark, schema, keep_corrupt).option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType,
                 keep_corrupt: bool = False) -> DataFrame:
    """Parquet files; they have no corrupt records, a broken file raises."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


_READERS = {"csv": read_csv, "ndjson": read_ndjson, "json_array": read_json_array,
            "parquet": read_parquet, "parquet_stream": read_parquet}
#: Formats whose records may be corrupt.
TEXT_FORMATS = ("csv", "ndjson", "json_array")


def project_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cut to a declared schema: those columns, in that order, cast to
    the declared types (an external table's fixed projection of a layer)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def register_external_view(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """Expose a published table to SQL users under ``name`` with its declared
    schema (a temporary view: lazy, re-reads the published files)."""
    view = project_to(df, schema)
    view.createOrReplaceTempView(name)
    return view


def read_source(spark: SparkSession, name: str, path: str,
                fmt: str | None = None, schema: T.StructType | None = None,
                keep_corrupt: bool = False) -> DataFrame:
    """Read a landing source by role name with its declared schema/format."""
    fmt = fmt or SOURCE_FORMATS[name]
    return _READERS[fmt](spark, path, schema or SOURCES[name], keep_corrupt=keep_corrupt)
