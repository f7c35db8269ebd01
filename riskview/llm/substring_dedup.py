"""Substring deduplication by Rabin-Karp window hashes.

Every window of ``width`` consecutive words is hashed with a rolling
polynomial, the hashes are counted over the whole corpus in Spark, and the
windows whose sequence starts more than once are merged into maximal intervals
of words to remove.

Plan.  Documents are dealt into blocks of bounded bytes by a hash of id and
text.  A block sends each distinct window hash once, packed per bucket of the
hash space, so copies, however many, cost at most one entry a block.  A bucket
answers each block with one bit a hash: seen in another block or not.  The
same blocks (the shuffle of the texts is reused) then combine those bits with
their own counts.  A key has 64 bits of one hash plus the bucket, which comes
from an independent second hash.  Nothing is collected, sampled or capped.

Cases: null or empty text has no words and nothing removed; a text shorter
than a window stays whole; repeated rows are separate documents, so their
windows repeat; a null id is carried through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import parts_for, text_bytes
from riskview.llm.words import Words, rolling, words_of

_OUT = "id {id}, n_words long, n_removed long, intervals array<struct<start:int,stop:int>>, kept_text string"


def _keys(words: Words, width: int, buckets: int) -> tuple[np.ndarray, ...]:
    """Window starts; distinct (bucket, hash) keys in order; each window's
    key; how often each key occurs here."""
    at = words.windows(width)
    h = rolling(words.codes(0), width, 0)[at]
    b = (rolling(words.codes(1), width, 1)[at] % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((h, b))
    hs, bs = h[order], b[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (bs[1:] != bs[:-1])
    key = np.empty(len(hs), dtype=np.int64)
    key[order] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(hs)))
    return at, bs[heads], hs[heads], key, counts


def _send(width: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary())])

    def run(docs: pa.Table) -> pa.Table:
        words = words_of(docs.column("text").combine_chunks())
        _, b, h, _, _ = _keys(words, width, buckets)
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        ends = np.append(cuts[1:], len(b))
        return pa.table({
            "block": pa.array([docs.column("block")[0].as_py()] * len(cuts), pa.int32()),
            "bucket": pa.array(b[cuts], pa.int32()),
            "hashes": pa.array([h[i:j].tobytes() for i, j in zip(cuts, ends)], pa.binary()),
        }, schema=schema)

    return run


def _answer(rows: pa.Table) -> pa.Table:
    """For each block of a bucket, a bit a hash: another block has it too."""
    parts = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("hashes").combine_chunks()]
    every = np.sort(np.concatenate(parts))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    block, bucket, bits = [], [], []
    if len(shared):
        for k, part in zip(rows.column("block").to_pylist(), parts):
            at = np.minimum(np.searchsorted(shared, part), len(shared) - 1)
            hit = shared[at] == part
            if hit.any():
                block.append(k)
                bucket.append(rows.column("bucket")[0].as_py())
                bits.append(np.packbits(hit).tobytes())
    return pa.table({"block": pa.array(block, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
                     "bits": pa.array(bits, pa.binary())})


def _remove(width: int, buckets: int, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        texts = docs.column("text").combine_chunks()
        words = words_of(texts)
        at, b, _, key, counts = _keys(words, width, buckets)
        repeated = counts > 1
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits")):
            i, j = np.searchsorted(b, bucket), np.searchsorted(b, bucket, side="right")
            repeated[i:j] |= np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=j - i).astype(bool)
        starts = at[repeated[key]]
        depth = np.zeros(len(words.start) + 1, dtype=np.int32)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + width, -1)
        gone = np.cumsum(depth[:-1]) > 0
        edges = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
        # an interval never leaves its text: cut covers at every text's edge
        first = words.first
        n_removed = np.add.reduceat(np.append(gone, False), first[:-1]) if len(first) > 1 else np.zeros(0, int)
        n_removed = np.where(words.per_doc > 0, n_removed, 0)
        intervals, kept = [], []
        opens, closes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        for d, text in enumerate(texts):
            lo, hi = first[d], first[d + 1]
            own = (text.as_buffer().to_pybytes() if text.is_valid and text.as_py() else b"").split()
            if not n_removed[d]:
                intervals.append([])
                kept.append(b" ".join(own))
                continue
            i, j = np.searchsorted(closes, lo, side="right"), np.searchsorted(opens, hi)
            spans = [(int(max(o, lo) - lo), int(min(c, hi) - lo)) for o, c in zip(opens[i:j], closes[i:j])]
            intervals.append([{"start": s, "stop": e} for s, e in spans])
            left, at_word = [], 0
            for s, e in spans:
                left += own[at_word:s]
                at_word = e
            kept.append(b" ".join(left + own[at_word:]))
        return pa.table([docs.column("id").combine_chunks(), pa.array(words.per_doc, pa.int64()),
                         pa.array(n_removed, pa.int64()), pa.array(intervals, schema.field("intervals").type),
                         pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)

    return run


def remove_repeats(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = 2 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Remove every word covered by a window that starts more than once.

    Returns id, n_words, n_removed, intervals (word positions, stop exclusive)
    and kept_text (kept words joined by one space).  ``block_bytes`` bounds
    the texts and ``bucket_bytes`` the hashes that one task holds; for
    hundreds of terabytes raise both, which keeps block-bucket messages long.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = text_bytes(docs, F.col("text"))
    blocks = parts_for(total, block_bytes)
    buckets = parts_for(total * 3 // 2, bucket_bytes)  # 8 bytes a word, at about 6 bytes of text
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
    schema = pa.schema([("id", _arrow(docs, "id")), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("intervals", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                        ("kept_text", pa.string())])
    sent = dealt.groupBy("block").applyInArrow(_send(width, buckets), "block int, bucket int, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer, "block int, bucket int, bits binary")
    out = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _remove(width, buckets, schema), _OUT.format(id=docs.schema["id"].dataType.simpleString()))
    return out.withColumnRenamed("id", id_col)


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)
