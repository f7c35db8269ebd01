import random
from collections import Counter

from riskview.llm.substring_dedup import remove_repeats
from tests.llm.helpers import AWKWARD, documents, words


def brute(pairs, width):
    seen = Counter(tuple(w[i:i + width]) for _, t in pairs for w in [words(t)] for i in range(len(w) - width + 1))
    out = []
    for d, t in pairs:
        w, gone = words(t), set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(spark, pairs, width, **how):
    docs = documents(spark, [t for _, t in pairs], [d for d, _ in pairs])
    out = remove_repeats(docs, width, **how).collect()
    for r in out:
        spans = [(s["start"], s["stop"]) for s in r["intervals"]]
        assert sum(e - s for s, e in spans) == r["n_removed"]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # maximal: none touch
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out), key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    shared = [rng.choices("abcdefgh", k=rng.randint(4, 30)) for _ in range(6)]
    pairs = []
    for d in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choices(["a", "b", "É", "dd", "x9,", "q"], k=rng.randint(0, 9)) + rng.choice(shared)
        pairs.append((d, rng.choice([" ", "\n", "  \t"]).join(w)))
    for width in (3, 5, 9):
        assert run(spark, pairs, width, block_bytes=300, bucket_bytes=2000) == brute(pairs, width)


def test_copies_and_awkward_texts(spark):
    pairs = [(i, t) for i, t in enumerate(AWKWARD)] + [(None, "p q r s t"), (5, "p q r s t"), (5, "p q r s t")]
    assert run(spark, pairs, 3) == brute(pairs, 3)


def test_empty_table(spark):
    assert run(spark, [], 35) == []
