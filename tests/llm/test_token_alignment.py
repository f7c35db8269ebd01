import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from riskview.llm import token_alignment
from riskview.llm.common import tokenizer_path
from riskview.llm.token_alignment import align, gallop, overlaps
from tests.llm.helpers import AWKWARD, documents, given

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
MORE = ["<|endoftext|> and <s> </s>", "▁ a mark of its own", "Ω≈ç√ 漢字 🙂🙂", "  two  spaces\n\n and lines ", "a",
        "NULL\x00byte", "don't won't I'll 1234567 3.14"]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(tokenizers, texts):
    """Every document by itself, token by token."""
    a, b = tokenizers
    letters = token_alignment.byte_letters()
    names = {i: t for t, i in a.get_vocab().items()}
    docs, pairs = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in names[i]) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                 for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            docs.append(([], [], [], []))
            continue
        spans = []
        for raw in (raw_a, raw_b):
            ends = np.cumsum([len(x) for x in raw]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [",".join(str(i) for i, (_, e) in zip(ids_a, spans[0]) if lo < e <= hi) + "|"
                  + ",".join(str(i) for i, (_, e) in zip(ids_b, spans[1]) if lo < e <= hi) for lo, hi in zip([0, *common], common)]
        links = [(i, j) for i, (s, e) in zip(ids_a, spans[0]) for j, (t, f) in zip(ids_b, spans[1]) if s < f and t < e]
        pairs.update(links)
        docs.append((ids_a, ids_b, groups, links))
    best = Counter()
    for (_, j), n in pairs.items():
        best[j] = max(best[j], n)
    return [(len(x), len(y), len(g), len(k), sum(pairs[p] == best[p[1]] for p in k), sum(pairs[p] for p in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if x else "") for x, y, g, k in docs]


def run(spark, texts, **how):
    out = align(documents(spark, texts), A, B, **how).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in out] == list(range(len(texts)))
    return [tuple(r)[1:] for r in out]


def test_against_brute_force(spark, tokenizers):
    texts = [t for t in AWKWARD if t is None or len(t) < 10_000] + MORE
    texts += [r["text"][:3000] if r["text"] else None for r in given(spark, "documents").orderBy("doc_id").limit(25).collect()]
    assert run(spark, texts) == brute(tokenizers, texts)
    assert run(spark, texts, most=500) == brute(tokenizers, texts)


def test_long_texts_in_runs(tokenizers):
    """Runs of units, aligned a few at a time, are one text."""
    text = " ".join(f"word{i} alpha beta, gamma's doné  x" for i in range(300))
    pair = token_alignment.Pair(A, B, most=20)
    units = pair.units(text)
    assert pair.cuts and len(units) > 300 and " ".join(units) == text
    both = [tuple(np.frombuffer(x, np.int32) for x in pair.encode([units[k:k + 11]])[0]) for k in range(0, len(units), 11)]
    assert np.concatenate([x for x, _ in both]).tolist() == tokenizers[0].encode(" " + text, add_special_tokens=False).ids
    assert np.concatenate([x for _, x in both]).tolist() == tokenizers[1].encode(text)
    doc = {"row": 1, "id": 1, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "left": len(both), "sha": hashlib.sha256()}
    rows = []
    for at in range(0, len(both), 7):
        rows += token_alignment._align(pair, at, [(doc, x, y) for x, y in both[at:at + 7]])
    got, = [r for r in rows if "id" in r]
    want, = brute(tokenizers, [text])
    assert (got["n_a"], got["n_b"], got["n_groups"], got["n_links"], got["groups_sha256"]) == (*want[:4], want[6])


def test_units_are_those_of_the_whole_text(tokenizers):
    pair = token_alignment.Pair(A, B)
    texts = [r for r in AWKWARD + MORE if r] + ["I'd've done it's end'll be x'S Y", "a b  c d\ne f ı İ ſ K x"]
    for text, got in zip(texts, pair.encode([pair.units(t) for t in texts])):
        ids = tokenizers[0].encode(" " + text, add_special_tokens=False).ids, tokenizers[1].encode(text)
        whole = all(v.spell(np.array(i)).tobytes() == (" " + text).encode() for v, i in zip((pair.bytes_a, pair.bytes_b), ids))
        assert (got is not None) == whole
        if got:
            assert tuple(np.frombuffer(x, np.int32).tolist() for x in got) == ids


def test_a_very_long_text(spark, tokenizers):
    text = "The quick brown fox, jumps over 12 lazy dogs. " * 12_000
    got, = run(spark, [text])
    assert got[0] == len(tokenizers[0].encode(" " + text, add_special_tokens=False).ids)
    assert got[1] == len(tokenizers[1].encode(text))


def test_repeated_rows_and_null_ids(spark):
    df = documents(spark, ["same text here"] * 2 + ["other"], ids=[5, 5, None])
    out = align(df, A, B).collect()
    assert sorted((r["doc_id"] or -1, r["n_a"] > 0) for r in out) == [(-1, True), (5, True), (5, True)]
    assert len({r["count_sum"] for r in out if r["doc_id"] == 5}) == 1


def test_empty_table(spark):
    assert align(documents(spark, []).where("doc_id < 0"), A, B).collect() == []


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.integers(0, 400)), st.lists(st.integers(0, 400), min_size=1))
def test_gallop_is_a_lower_bound(keys, into):
    keys, into = np.array(sorted(keys), dtype=np.int64), np.array(sorted(into))
    assert gallop(keys, into).tolist() == np.searchsorted(into, keys).tolist()


@settings(max_examples=200, deadline=None)
@cases(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_overlaps_of_every_pair(x, y):
    a, b = (np.array(sorted(s | {61})) for s in (x, y))
    ia, ib, la, lb = overlaps(a, b)
    assert a[ia].tolist() == b[ib].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    want = [(i, j) for i in range(len(a)) for j in range(len(b))
            if (a[i - 1] if i else 0) < b[j] and (b[j - 1] if j else 0) < a[i]]
    assert sorted(zip(la.tolist(), lb.tolist())) == want


def test_units_are_encoded_many_at_a_time():
    """Unknown units share texts, and their ids are those of each alone; units
    that are not given back, or that white space ends, do not spoil the others."""
    rng = random.Random(4)
    units = sorted({"".join(rng.choices(["th", "'s", "é", "日", "12", "<|endoftext|>", "\x00", "Z", "–", "\n", "_"], k=rng.randint(1, 6)))
                    for _ in range(1500)})
    units += ["", " a", "a ", "a  b", " x", "x▁y", "▁", "\x1fq", "​"]
    pair = token_alignment.Pair(A, B)
    asked = []

    class Counted:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    tokenizer, pair.a = pair.a, Counted()
    many = pair.learn(units)
    assert len(asked) < len(units) / 2
    pair.cuts = False  # every unit on its own
    assert many == pair.learn(units)
    assert "x▁y" not in many[0] and "a  b" in many[0]
