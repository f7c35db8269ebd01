import numpy as np
import pytest
from pyspark.sql import functions as F

from riskview.llm import subword_classifier, toxicity_trees
from riskview.llm.queries import op4_subword_classifier, op8_toxicity_trees
from tests.conftest import SF_ORACLE
from tests.llm.helpers import AWKWARD, documents


def judged(spark, query, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    rows = [r for r in query(spark, SF_ORACLE).collect()]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    return [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_quality_on_held_out_documents(spark):
    pairs = judged(spark, op4_subword_classifier, "quality")
    assert np.mean([p == y for p, y in pairs]) >= 0.97


def test_toxicity_on_held_out_documents(spark):
    pairs = judged(spark, op8_toxicity_trees, "toxic")
    assert np.mean([p == y for p, y in pairs]) >= 0.95
    assert np.mean([p for p, y in pairs if y]) >= 0.5


def test_held_out_is_the_crc_of_the_id(spark):
    import zlib
    got = spark.range(-5, 60).select("id", subword_classifier.held_out("id", 3, 1).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


@pytest.mark.parametrize("classify", [subword_classifier.classify, toxicity_trees.classify])
def test_awkward_texts_score_alike_and_labels_may_miss(spark, classify):
    docs = documents(spark, AWKWARD * 2, [None, *range(1, 2 * len(AWKWARD))])
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (77, 0), (5, 0), (6, 1)], "doc_id long, y int")
    for known in (labels, labels.where("y = 1"), labels.limit(0)):
        out = classify(docs, known, "y", subword_classifier.held_out("doc_id", 3, 1)).collect()
        assert len(out) == 2 * len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out)
    by_text = {}
    for t, r in zip(AWKWARD * 2, sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"]))):
        by_text.setdefault(t or "", set()).add(round(r["score"], 9))
    assert all(len(s) == 1 for s in by_text.values())
    assert classify(docs.limit(0), labels, "y", F.lit(False)).collect() == []


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    t = toxicity_trees.grow(x[:1500], y[:1500], toxicity_trees.Training())
    assert np.mean((t.odds(x[1500:]) > 0) == (y[1500:] > 0)) > 0.95


def test_isotonic_is_rising_and_fits_means():
    z, y = np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 0, 1, 0, 1, 1])
    knots, shares = toxicity_trees.isotonic(z, y)
    assert (np.diff(shares) >= 0).all() and shares[0] < 0.2 and shares[-1] > 0.8
    assert abs(np.interp(3.5, knots, shares) - 0.5) < 0.01


def test_isotonic_pools_ties_whatever_the_order():
    rng = np.random.default_rng(1)
    z, y = rng.integers(0, 6, 60).astype(float), rng.integers(0, 2, 60).astype(float)
    want = toxicity_trees.isotonic(z, y)
    for _ in range(20):
        order = rng.permutation(60)
        got = toxicity_trees.isotonic(z[order], y[order])
        assert np.array_equal(got[0], want[0]) and np.allclose(got[1], want[1], atol=0)
    for ones in ([1, 1, 0, 0], [0, 0, 1, 1], [1, 0, 1, 0]):
        knots, shares = toxicity_trees.isotonic(np.full(4, 2.0), np.array(ones, dtype=float))
        assert np.interp(2.0, knots, shares) == 0.5


def test_weights_count_like_repeated_rows():
    rng = np.random.default_rng(2)
    x, z = rng.random((300, 3)), rng.integers(0, 9, 300).astype(float)
    y = (x[:, 0] + rng.random(300) > 1).astype(float)
    weight = np.where(y > 0, 1.0, 3.0)
    again = np.repeat(np.arange(300), weight.astype(int))
    assert np.allclose(toxicity_trees.isotonic(z, y, weight)[1], toxicity_trees.isotonic(z[again], y[again])[1])
    t = toxicity_trees.Training(trees=8, bins=4)
    few = np.round(x * 3) / 3  # the same cuts for both
    assert np.allclose(toxicity_trees.grow(few, y, t, weight).odds(few), toxicity_trees.grow(few[again], y[again], t).odds(few))


@pytest.mark.parametrize("module", [subword_classifier, toxicity_trees])
def test_a_capped_class_keeps_its_weight(spark, module):
    """Three of four labels are of class 0, with and without a cap on it."""
    rng = np.random.default_rng(4)
    texts, marks = [], []
    for i in range(400):
        one = i % 4 == 0
        words = ["plain", "words", "and", "more"] + (["trash", "scum"] if rng.random() < (0.6 if one else 0.2) else ["fine"])
        texts.append(" ".join(rng.permutation(words)))
        marks.append((i, int(one)))
    docs, labels = documents(spark, texts), spark.createDataFrame(marks, "doc_id long, y int")
    means = [np.mean([r["score"] for r in module.classify(docs, labels, "y", F.lit(False), module.Training(per_class=n)).collect()])
             for n in (400, 100)]
    assert np.isfinite(means).all()
    assert module is subword_classifier or abs(means[0] - means[1]) < 0.1  # noisy labels: the vectors only stay within bounds
    assert subword_classifier.class_weights(labels, "y", 400, "doc_id") == (1.0, 1.0)
    assert subword_classifier.class_weights(labels, "y", 100, "doc_id") == (1.5, 0.5)


def test_features_see_obfuscation_capitals_and_second_person():
    import pyarrow as pa
    second = toxicity_trees.fixed_codes(toxicity_trees.SECOND_PERSON)
    lexicon = toxicity_trees.Lexicon(toxicity_trees.fixed_codes(toxicity_trees.INSULTS))
    x = toxicity_trees.features(pa.array(["you are a moron!", "id1ot YOU sooooo", "plain words here", ""]), lexicon, second, 4)
    f = {n: x[:, i] for i, n in enumerate(toxicity_trees.NAMES)}
    assert f["hits"].tolist() == [1, 0, 0, 0] and f["close"].tolist() == [1, 0, 0, 0]
    assert f["mixed"][1] > 0 and f["drawn_out"][1] > 0 and f["shouted"][1] > 0 and not x[3].any()
