"""The pipeline stage by stage against plain versions, on planted documents."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from riskview.llm.queries import op8_toxicity_trees
from tests.conftest import SF_ORACLE
from tests.llm.helpers import given
from tests.llm.test_chosen_path import brute as groups
from tests.llm.test_decontamination import brute as leaks

SF = "/root/testdata/sf0.001"


def test_stages_are_four_or_five_with_names():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "pieces"]


def test_toxicity_drops_what_the_trees_predict(spark):
    docs = given(spark, "documents", SF_ORACLE)
    kept = corpus_pipeline.drop_toxic(spark, docs, SF_ORACLE)
    assert kept.columns == docs.columns
    clean = {r["doc_id"] for r in op8_toxicity_trees(spark, SF_ORACLE).where("predicted = 0").collect()}
    assert {r["doc_id"] for r in kept.collect()} == clean


def test_near_duplicates_and_leaks_on_planted_documents(spark):
    rng = random.Random(1)
    docs = given(spark, "documents", SF)
    rows = [r for r in docs.orderBy("doc_id").collect()]
    items = [r["text"] for r in given(spark, "benchmark", SF).collect()]
    long = next(r for r in rows if len(r["text"].split()) > 150)
    near = long["text"].split()
    near[rng.randrange(len(near))] = "changed"
    planted = [(9001, long["text"]), (9002, " ".join(near)), (9003, "clean start here " + items[0] + " end"), (9004, None), (9005, "")]
    extra = spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in planted], docs.schema)
    every = docs.union(extra)
    pairs = [(r["doc_id"], r["text"]) for r in every.collect()]

    kept = corpus_pipeline.drop_near_duplicates(spark, every, SF)
    want = {d for d, _, c, _ in groups(pairs, 5, 80) if d == c}
    assert {r["doc_id"] for r in kept.collect()} == want and not want & {9001, 9002} and {9004, 9005} <= want

    clean = corpus_pipeline.drop_leaks(spark, every, SF)
    bad = {d for d, t in pairs if t and any(leaks(t, b, 8) for b in items)}
    assert 9003 in bad and {r["doc_id"] for r in clean.collect()} == {d for d, _ in pairs} - bad
    assert clean.columns == kept.columns == docs.columns


def test_run_equals_the_stages_in_turn(spark):
    docs = given(spark, "documents", SF)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    want = sorted(map(str, docs.collect()))
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, out.collect())) == want
    assert out.where(F.size("pieces") != F.col("n_pieces")).count() == 0
