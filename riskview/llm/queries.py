"""Registered queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskview.llm import (
    chosen_path,
    decontamination,
    exact_topk,
    filter_audit,
    metric_join,
    subword_classifier,
    substring_dedup,
    surrogates,
    token_alignment,
    token_files,
    toxicity_trees,
    url_rules,
    wfst_pieces,
)
from riskview.llm.common import read_table, tokenizer_path
from riskview.session import scratch_path

#: The rules of the URL query, host/path and verdict.
URL_RULES = (
    url_rules.Rule("org/", "allow"),
    url_rules.Rule("example.org/es/", "block"),
    url_rules.Rule("example.org/en/1", "block"),
    url_rules.Rule("com/fr/", "allow"),
    url_rules.Rule("com/de/", "block"),
)
#: Globs that block a URL no rule decides.
BLOCK_GLOBS = ("*spam-*", "*cheap-pills*", "*casino*", "*/*.exe", "*/*.zip")
#: The filters that are audited.
AUDITED = {
    "A": filter_audit.few_words(200),
    "B": filter_audit.repeated_words(50),
    "C": filter_audit.many_capitals(2),
    "D": filter_audit.holds_any("#$%&*|"),
    "E": filter_audit.Copy(),
}
#: The key of the surrogates; a deployment passes a secret of its own.
SURROGATE_KEY = "surrogates"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"),
                                  path, end_id=1)
    return token_files.digest_token_files(spark, path)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), width=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(read_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op4_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                       "quality", subword_classifier.held_out("doc_id", 3, 1))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.redact(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(read_table(spark, sf_dir, "documents"), chosen_path.Join(width=5, percent=85))


def op7_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("key")


def op8_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_trees.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                   "toxic", subword_classifier.held_out("doc_id", 5, 0))


def op9_wfst_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst_pieces.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages"), URL_RULES, BLOCK_GLOBS)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"), "toxic")
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), AUDITED, F.col("source"), marks, ("good", "toxic"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                 tokenizer_path("piece_bpe_32k.model"))


def op13_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(read_table(spark, sf_dir, "embeddings"), metric_join.Range(least=0.95))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_substring_dedup, op3_exact_topk, op4_subword_classifier, op5_surrogates, op6_chosen_path,
    op7_template_windows, op8_toxicity_trees, op9_wfst_pieces, op10_url_rules, op11_filter_audit, op12_token_alignment,
    op13_metric_join)}
