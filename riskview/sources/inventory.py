"""Landing inventory: files and sizes per expected source folder.

One distributed listing of the landing root via the ``binaryFile`` source
with the ``content`` column pruned (only metadata is read).  An expected
folder without files still gets a row (``files = 0``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landing_files(spark: SparkSession, root: str) -> DataFrame:
    """``folder, file_name, bytes, size_kb, modified`` for every file under
    root; none if root is missing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "folder string, file_name string, bytes long, "
                                         "size_kb double, modified timestamp")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(root).select("path", "length", "modificationTime"))
    # the listed paths carry a scheme (file:, s3a://...): match the root's
    # path part literally, wherever the scheme ends
    base = re.escape(root.rstrip("/").split(":")[-1] + "/")
    rel = F.regexp_replace(F.col("path"), "^.*?" + base, "")
    return files.select(
        F.split(rel, "/").getItem(0).alias("folder"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.round(F.col("length") / 1024.0, 1).alias("size_kb"),
        F.col("modificationTime").alias("modified"))


def landing_inventory(spark: SparkSession, root: str,
                      expected: Sequence[str]) -> DataFrame:
    """Per expected folder: ``folder, files, total_kb, present``."""
    agg = (landing_files(spark, root).groupBy("folder")
           .agg(F.count(F.lit(1)).alias("files"), F.round(F.sum("bytes") / 1024.0, 1).alias("total_kb")))
    exp = spark.createDataFrame([(f,) for f in expected], "folder string")
    return (exp.join(agg, "folder", "left")
            .select("folder", F.coalesce("files", F.lit(0)).alias("files"),
                    F.coalesce("total_kb", F.lit(0.0)).alias("total_kb"),
                    (F.coalesce("files", F.lit(0)) > 0).alias("present")))
