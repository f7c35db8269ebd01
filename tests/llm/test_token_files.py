import zlib

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskview.llm import token_files as tf
from riskview.llm.common import tokenizer_path
from riskview.session import scratch_path
from tests.llm.helpers import AWKWARD, documents, given

PATH = tokenizer_path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@cases(st.lists(st.integers(0, 2**63 - 1), max_size=700))
def test_elias_fano_gives_back_every_value(values):
    values = np.array(sorted(values), dtype=np.uint64)
    coded, _ = tf.EliasFano.read(memoryview(tf.EliasFano.of(values).to_bytes()), 0)
    assert coded.values().tolist() == values.tolist()
    assert [coded.select(i) for i in range(len(values))] == values.tolist()


def test_boundaries_take_few_bits():
    bounds = np.cumsum(np.random.default_rng(0).integers(50, 3000, 20_000))
    assert len(tf.EliasFano.of(bounds).to_bytes()) * 8 / len(bounds) < 2 + np.log2(1525) + 1


def test_shard_round_trip():
    ids = [np.arange(n, dtype=np.uint32) for n in (3, 0, 5)]
    docs, flat, bounds = tf.unpack_shard(tf.pack_shard([None, -7, 4], ids, 2))
    assert docs == [None, -7, 4] and flat.tolist() == [0, 1, 2, 0, 1, 2, 3, 4] and bounds.values().tolist() == [0, 3, 3, 8]
    assert tf.unpack_shard(tf.pack_shard([], [], 4))[0] == []


def expected(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def digests(spark, docs, **how):
    path = scratch_path(spark, "token-files-test")
    tf.write_token_files(docs, PATH, path, end_id=1, **how)
    return path, sorted((tuple(r) for r in tf.digest_token_files(spark, path).collect()), key=lambda r: r[1])


def brute(pairs):
    out, start = [], 0
    for (d, _), ids in zip(pairs, expected([t for _, t in pairs])):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_of_a_table(spark):
    docs = given(spark, "documents")
    pairs = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert digests(spark, docs, shard_bytes=20_000, part_bytes=50_000)[1] == brute(pairs)


def test_awkward_texts_and_ids(spark):
    texts = AWKWARD + ["it's 12x ΑΣ Σ. İstanbul x<|endoftext|>y é,́ ẞ ŉ... ǅ, don't.! ﬁ ª.º"]
    ids = [None, -5, 3, 3, 9, 10, 11, 20, 21, 22]
    path, got = digests(spark, documents(spark, texts, ids))
    by_id = {}
    for d, ids_ in zip(ids, expected(texts)):
        by_id.setdefault(d, []).append((len(ids_), zlib.crc32(np.array(ids_, "<u4").tobytes())))
    assert [g[0] for g in got] == [None, -5, 3, 3, 9, 10, 11, 20, 21, 22]
    assert [g[1] for g in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    for d, _, n, crc in got:
        assert (n, crc) in by_id[d]
    back = {r["doc_id"]: r["ids"] for r in tf.read_token_files(spark, path).collect()}
    assert back[22] == expected(texts)[-1]


def test_empty_table(spark):
    assert digests(spark, documents(spark, []))[1] == []


def test_a_tokenizer_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        tf.WordEncoder(tokenizer_path("byte_bpe_50k.json"))
