import random

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from riskview.llm import wfst_pieces
from riskview.llm.common import tokenizer_path
from tests.llm.helpers import AWKWARD, documents, given

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(texts):
    flat, first = wfst_pieces.transducer(PATH).encode(pa.array(texts, pa.string()))
    return [flat[i:j].tolist() for i, j in zip(first[:-1], first[1:])]


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.one_of(st.text(max_size=40), st.text(" \r\n\t▁abcdeinotrs.,'é日", max_size=60)), min_size=1, max_size=5))
def test_encoding_equals_the_library(texts):
    assert encoded(texts) == [LIBRARY.encode(t) for t in texts]


@settings(max_examples=100, deadline=None)
@cases(st.text(max_size=40))
def test_round_trip(text):
    t = wfst_pieces.transducer(PATH)
    ids, _ = t.encode(pa.array([text]))
    assert t.decode(ids) == LIBRARY.decode(LIBRARY.encode(text))


def test_a_table_and_awkward_texts(spark):
    docs = given(spark, "documents").select("doc_id", "text")
    docs = docs.union(documents(spark, AWKWARD, [None] * len(AWKWARD)).select("doc_id", "text"))
    texts = {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    out = wfst_pieces.encode(docs, PATH).collect()
    assert len(out) == docs.count()
    assert {(r["doc_id"], r["decoded"]) for r in out} == texts
    for r in out:
        assert r["pieces"] == LIBRARY.encode(r["decoded"]) and r["n_pieces"] == len(r["pieces"])
    back = wfst_pieces.decode(wfst_pieces.encode(docs, PATH, decode=False), PATH)
    assert {(r["doc_id"], r["text"]) for r in back.collect()} == texts


def test_empty_table(spark):
    assert wfst_pieces.encode(documents(spark, []), PATH).collect() == []


def test_unigram_weights_take_the_cheapest_path(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    for piece, score, kind in (("<unk>", 0, 2), ("▁", -5, 1), ("a", -4, 1), ("b", -4, 1), ("ab", -3, 1), ("▁a", -1, 1)):
        p = m.pieces.add()
        p.piece, p.score, p.type = piece, score, kind
    m.trainer_spec.model_type = 1
    m.normalizer_spec.remove_extra_whitespaces = False
    path = tmp_path / "m.model"
    path.write_bytes(m.SerializeToString())
    t = wfst_pieces.Transducer(str(path))
    ids, _ = t.encode(pa.array(["ab", "abab", "axb"]))
    assert [t.pieces[i] for i in ids] == ["▁a", "b", "▁a", "b", "ab", "▁a", "<unk>", "b"]


def test_pieces_with_control_characters():
    texts = ["\r", "a\r\nb", "\t\t", " \r x", "a\x1fb"]
    assert encoded(texts) == [LIBRARY.encode(t) for t in texts]


def test_other_normalisers_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "m.model"
    path.write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        wfst_pieces.Transducer(str(path))


def test_new_parts_are_searched_together(monkeypatch):
    """Words seen for the first time share one search over arrays: none has a
    search of its own, whatever dead ends it meets, and ids stay the library's."""
    rng = random.Random(5)
    bits = ["th", "an", "er", "tion", "é", "ción", "ß", "qu", "ou", "x", "'", "日", "7", "Q"]
    texts = [" ".join("".join(rng.choices(bits, k=rng.randint(1, 9))) for _ in range(400)) for _ in range(5)]
    t = wfst_pieces.Transducer(PATH)
    alone = []
    monkeypatch.setattr(t, "_allowed_path", lambda text, search=t._allowed_path: alone.append(text) or search(text))
    flat, first = t.encode(pa.array(texts, pa.string()))
    assert [flat[i:j].tolist() for i, j in zip(first[:-1], first[1:])] == [LIBRARY.encode(x) for x in texts]
    assert [x for x in alone if len(x) < 32 and t.single.issuperset(x)] == []
    words = [p for p in t.parts if t.single.issuperset(p)]
    assert len(words) > 1000 and [list(memoryview(t.parts[p]).cast("I")) for p in words] == [t._allowed_path(p) for p in words]
