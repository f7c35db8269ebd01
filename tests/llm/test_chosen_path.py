import random

import pytest

from riskview.llm import chosen_path
from riskview.llm.chosen_path import Join, keep_first, near_duplicates
from riskview.llm.components import components
from tests.llm.helpers import AWKWARD, documents, given, words


def shingles(text, width):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(pairs, width, percent):
    sets = [shingles(t, width) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    group = {}
    for i, (d, _) in enumerate(pairs):
        group.setdefault(find(i), []).append(d)
    least = [min((d for d in group[find(i)] if d is not None), default=None) for i in range(len(pairs))]
    return sorted(((d, len(s), c, None if d is None or c is None else d == c)
                   for (d, _), s, c in zip(pairs, sets, least)), key=str)


def run(spark, pairs, how):
    docs = documents(spark, [t for _, t in pairs], [d for d, _ in pairs])
    return sorted((tuple(r) for r in near_duplicates(docs, how).collect()), key=str)


def corpus(seed):
    """Groups of near copies of several sizes, copies, and texts that share a
    passage without being alike."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, passage = [], rng.choices(vocabulary, k=30)
    for size in (2, 3, 9, 60):
        base = rng.choices(vocabulary, k=120)
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    texts += [" ".join(rng.choices(vocabulary, k=60) + passage) for _ in range(40)]
    texts += texts[:10] + [texts[0].upper(), "  ".join(texts[3].split())]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("percent,small", [(85, 512), (85, 8), (80, 16)])
def test_against_brute_force(spark, percent, small):
    pairs = corpus(percent + small)
    assert run(spark, pairs, Join(percent=percent, small=small, pivots=2)) == brute(pairs, 5, percent)


def test_awkward_texts_and_ids(spark):
    pairs = [(i, t) for i, t in enumerate(AWKWARD)]
    pairs += [(None, AWKWARD[7]), (None, "quite alone"), (50, AWKWARD[8]), (50, AWKWARD[8]), (3, "ONE"), (4, "one two three four")]
    assert run(spark, pairs, Join(percent=85)) == brute(pairs, 5, 85)


def test_empty_table(spark):
    assert run(spark, [], Join()) == []
    assert keep_first(documents(spark, [])).collect() == []


def test_keep_first_leaves_one_of_each_group(spark):
    text = "a b c d e f g h"
    pairs = [(5, text), (3, text), (3, text), (9, text.upper()), (7, "x y z"), (7, "x y z"), (1, None), (2, ""), (None, text)]
    docs = documents(spark, [t for _, t in pairs], [d for d, _ in pairs])
    out = keep_first(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r)[:2] for r in out.collect()) == [(1, None), (2, ""), (3, text), (7, "x y z")]


def test_kept_documents_of_a_table(spark):
    docs = given(spark, "documents")
    ids = {r["component_id"] for r in near_duplicates(docs, Join()).collect()}
    assert {r["doc_id"] for r in keep_first(docs).collect()} == ids


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_small_nodes_of_all_levels_share_one_pass(spark, monkeypatch):
    taken, reads = chosen_path._candidates, []

    def read(*args):
        out = taken(*args)
        reads.append(out._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInArrow"))
        return out

    monkeypatch.setattr(chosen_path, "_candidates", read)
    pairs = corpus(3)
    assert run(spark, pairs, Join(percent=85, small=4, pivots=2)) == brute(pairs, 5, 85)
    assert reads == [1]
