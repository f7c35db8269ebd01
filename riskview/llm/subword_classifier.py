"""Supervised subword embeddings for document quality.

A document is the average of learned vectors of its words, of the byte n-grams
of each word between its marks ``<`` and ``>``, of a feature for a word that
repeats the one before it, and of one feature every document has.  Features
are hashed into ``buckets`` rows.  A softmax layer on that average gives the
class; vectors and layer are trained by stochastic gradient descent in numpy.

The layer is linear, so a trained model scores with one number a bucket: a
document's log-odds are the mean of its features' numbers.  Every distinct
word of a chunk is featurised once.

Cases: null or empty text has only the common feature and gets its score;
rows without a label, or with a null one, do not train; with no labels at all,
or one class only, scores follow that class's share.  Repeated rows score
alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import slices
from riskview.llm.words import Words, mix, words_of

_COMMON, _REPEAT = 0, 1  # buckets of their own; hashes take the others
_GRAM = np.random.default_rng(21).integers(1, 2 ** 63, 8, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Training:
    """Parameters: n-gram lengths, buckets, vector size, passes, step, the
    most labelled documents of each class that a model is fitted on, and the
    bound of a vector's components."""

    grams: tuple[int, ...] = (2, 3, 4)
    buckets: int = 1 << 16
    dim: int = 16
    epochs: int = 12
    step: float = 2.0
    per_class: int = 1500
    bound: float = 64.0


def _word_features(words: Words, which: np.ndarray, codes: np.ndarray, t: Training) -> tuple[np.ndarray, np.ndarray]:
    """Features of the words ``which``: (position in ``which``, bucket)."""
    size = words.end[which] - words.start[which]
    ends = np.cumsum(size + 2)
    text = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    of = np.repeat(np.arange(len(which)), size + 2)
    at = np.arange(len(text)) - (ends - size - 2)[of]
    inner = (at > 0) & (at <= size[of])
    text[inner] = words.data[(words.start[which])[of[inner]] + at[inner] - 1]
    text[at == 0] = 256
    text[~inner & (at > 0)] = 257
    owner, bucket = [np.arange(len(which))], [codes[which]]
    for n in t.grams:
        k = len(text) - n + 1
        if k <= 0:
            continue
        whole = np.flatnonzero(of[:k] == of[n - 1:])
        h = np.full(len(whole), n, dtype=np.uint64)
        for j in range(n):
            h += (text[whole + j] + np.uint64(1)) * _GRAM[j]
        owner.append(of[whole])
        bucket.append(mix(h))
    return np.concatenate(owner), (np.concatenate(bucket) % np.uint64(t.buckets - 2) + np.uint64(2)).astype(np.int64)


def _repeats(words: Words, codes: np.ndarray) -> np.ndarray:
    """Indices of words equal to the one before them in the same text."""
    return 1 + np.flatnonzero((codes[1:] == codes[:-1]) & (words.doc[1:] == words.doc[:-1]))


def _counts(t: Training) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bucket counts of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text", 1 << 20):
                words = words_of(few.column("text"))
                codes = words.codes()
                _, where, which = np.unique(codes, return_index=True, return_inverse=True)
                owner, bucket = _word_features(words, where, codes, t)
                order = np.argsort(owner, kind="stable")
                heads = np.searchsorted(owner[order], np.arange(len(where) + 1))
                again = _repeats(words, codes)
                rows = []
                for d, (lo, hi) in enumerate(zip(words.first[:-1], words.first[1:])):
                    own, times = np.unique(which[lo:hi], return_counts=True)
                    parts = [bucket[order[heads[w]:heads[w + 1]]] for w in own]
                    sizes = heads[own + 1] - heads[own]
                    tally = np.bincount(np.concatenate(parts) if parts else np.zeros(0, int),
                                        weights=np.repeat(times, sizes) if parts else None, minlength=2)
                    tally[_COMMON] = 1
                    tally[_REPEAT] = np.count_nonzero((again >= lo) & (again < hi))
                    used = np.flatnonzero(tally)
                    rows.append((used.astype("<i4").tobytes(), tally[used].astype("<f4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [few.column("label"), pa.array([r[0] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["label", "buckets", "counts"])
    return run


def fit(labels: list[int], docs: list[tuple[np.ndarray, np.ndarray]], t: Training) -> np.ndarray:
    """Log-odds of class 1 for every bucket."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    if len(set(labels)) < 2:
        return np.full(t.buckets, np.log(share / (1 - share)), dtype=np.float32)
    rng = np.random.default_rng(7)
    vec = rng.uniform(-1 / t.dim, 1 / t.dim, (t.buckets, t.dim)).astype(np.float32)
    out = np.zeros((2, t.dim), dtype=np.float32)
    mean = [(ids, (c / c.sum()).astype(np.float32)) for ids, c in docs]
    total, done = t.epochs * len(docs), 0
    for _ in range(t.epochs):
        for i in rng.permutation(len(docs)):
            ids, weight = mean[i]
            own = vec[ids]
            h = weight @ own
            z = out @ h
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step = t.step * (1 - done / total)
            # within bounds that a fit of separable texts never meets: few words under noisy labels would diverge
            vec[ids] = np.clip(own - np.outer(weight * step * min(len(ids), 64), out.T @ p), -t.bound, t.bound)
            out = np.clip(out - step * np.outer(p, h), -t.bound, t.bound)
            done += 1
    return vec @ (out[1] - out[0])


def _scores(odds: np.ndarray, t: Training, shift: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text"):
                words = words_of(few.column("text"))
                codes = words.codes()
                _, where, which = np.unique(codes, return_index=True, return_inverse=True)
                owner, bucket = _word_features(words, where, codes, t)
                value = np.bincount(owner, weights=odds[bucket], minlength=len(where))
                number = np.bincount(owner, minlength=len(where))
                sums = np.bincount(words.doc, weights=value[which], minlength=few.num_rows) + odds[_COMMON]
                sizes = np.bincount(words.doc, weights=number[which], minlength=few.num_rows) + 1
                again = np.bincount(words.doc[_repeats(words, codes)], minlength=few.num_rows)
                z = np.clip((sums + again * odds[_REPEAT]) / (sizes + again) + shift, -40, 40)
                yield pa.RecordBatch.from_arrays(
                    [few.column("id"), few.column("held_out"), pa.array(1 / (1 + np.exp(-z)), pa.float64())],
                    names=["id", "held_out", "score"])
    return run


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32(id as text) mod ``folds`` is ``fold``; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample_of(labels: DataFrame, label: str, per_class: int, id_col: str) -> DataFrame:
    """At most ``per_class`` labelled ids of each class, by a hash of the id."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL")
    few = [rows.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_class) for k in (0, 1)]
    return few[0].union(few[1])


def class_weights(labels: DataFrame, label: str, per_class: int, id_col: str) -> tuple[float, float]:
    """By how much a row of either class stands for more rows than a sampled
    one does on average: the class's share of all labels over its share of
    ``sample_of``.  Both are 1 where no class is capped."""
    rows = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(label).cast("int").alias("k")).agg(F.count("*").alias("n"))
    size = {r["k"]: r["n"] for r in rows.where("k IN (0, 1)").collect()}
    taken = {k: min(n, per_class) for k, n in size.items()}
    mean = sum(size.values()) / max(1, sum(taken.values()))
    return tuple(size[k] / taken[k] / mean if k in size else 1.0 for k in (0, 1))


def classify(docs: DataFrame, labels: DataFrame, label: str, out: Column, t: Training = Training(),
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every document: id, held_out, score, predicted.

    ``labels`` holds id and ``label``; ``out`` (over the id column) marks ids
    whose labels are not learned from.  The fit takes at most
    ``t.per_class`` documents of each class; scoring reads every whole text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), out.alias("held_out"))
    known = sample_of(labels.where(~out), label, t.per_class, id_col)
    # the log-odds are those of the sample: a capped class counts for all its labels
    common, rare = class_weights(labels.where(~out), label, t.per_class, id_col)
    shift = float(np.log(rare / common))
    # an id counts once, however often its rows and labels repeat
    train = (rows.select("id", "text").join(F.broadcast(known), "id").groupBy("id")
             .agg(F.max("label").alias("label"), F.min("text").alias("text")))
    seen = train.mapInArrow(_counts(t), "label int, buckets binary, counts binary").toPandas()
    seen = seen.sort_values(["label", "buckets", "counts"], ignore_index=True)  # whatever order tasks end in
    odds = fit(seen["label"].tolist(), [(np.frombuffer(i, "<i4"), np.frombuffer(c, "<f4"))
                                        for i, c in zip(seen["buckets"], seen["counts"])], t).astype(np.float32)
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(_scores(odds, t, shift), f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
