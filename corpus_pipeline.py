"""Corpus cleaning: toxic documents, near duplicates and benchmark passages go,
personal data is replaced, and what is left is encoded.

Every stage takes all documents its predecessor kept and, but for the last,
returns the columns of ``documents``.  ``run`` writes each stage as Parquet
under the shared scratch folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskview.llm import chosen_path, decontamination, surrogates, toxicity_trees, wfst_pieces
from riskview.llm.common import read_table, stored, tokenizer_path
from riskview.llm.queries import SURROGATE_KEY
from riskview.llm.subword_classifier import held_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity trees do not predict toxic."""
    model = toxicity_trees.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0)), "toxic",
                               toxicity_trees.Training(), "doc_id", "text")
    return toxicity_trees.filter_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8)."""
    return chosen_path.keep_first(docs, chosen_path.Join(width=5, percent=80))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the text."""
    return surrogates.redact_table(docs, SURROGATE_KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and the text they decode to."""
    return wfst_pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", replace_personal_data),
    ("pieces", encode),
]

#: The trees, the join's trees and the transducer have no SQL: tested against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
