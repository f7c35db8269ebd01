"""Shared by the tests of the subpackage."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: Texts that every operator on documents has to stand.
AWKWARD = [None, "", " \t\n ", "one", "\x00 \u0001 \u0002 \u0003a \u0003", "émigré ÉCOLE ß 日本語 \U0001F600 x", "a " * 30_000,
           "same words here and there", "same words here and there"]


def documents(spark: SparkSession, texts, ids=None):
    """A documents table with an extra column whose name clashes with names
    used inside operators."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "x", 1, "key") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n int, key string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def given(spark, name, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/{name}.parquet")
