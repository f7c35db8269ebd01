"""Helpers shared by the operators of this subpackage.

Convention: an operator names its id and text columns by parameter, projects
them to private names first and returns only documented columns, so extra
columns of the input, whatever their names, never clash.
"""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskview.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: every
    later reader sees the same rows, and a lost executor cannot change them.
    ``rows``, if known, is a bound of its narrow rows: 20,000 share a file, so
    few do not become a file a shuffle partition; all cores write in any case."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, parts_for(rows, 20_000)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use``
    refers to it inside a function of array elements."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_bytes(docs: DataFrame, text: Column) -> int:
    """UTF-8 bytes of all texts (partial sums, one number)."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts_for(total_bytes: int, each_bytes: int) -> int:
    """How many parts keep each near ``each_bytes``."""
    return max(1, math.ceil(total_bytes / each_bytes))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds more than ``max_bytes`` of
    ``column`` (a single longer text is a slice of its own)."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving freed memory back to the system at
    the end of a partition: a worker lives on, and what its allocators keep
    would count against the tasks and stages after it."""
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)
    return inner


def tokenizer_path(name: str) -> str:
    """Where a file of the public tokenizers lies."""
    import public_tokenizers
    return public_tokenizers.path(name)
