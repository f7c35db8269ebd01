"""Toxicity by gradient-boosted trees over dense features.

Features of a text: densities of a word lexicon and of a word-stem lexicon,
lexicon hits close to a second-person word, rates of capitals, punctuation,
other marks, digits and obfuscated words (letters mixed with digits or marks,
or one letter three times running), and sizes.  The lexicons hold a few fixed
words and what one part of the labelled sample shows to be typical of toxic
texts; trees are grown on a second part and an isotonic calibration is fitted
on a third, so no part judges what it has taught.

All words of a chunk are featurised together with numpy; the model (lexicon
hashes and small trees) is bounded by its parameters and travels with the
tasks.

Cases: null or empty text has all-zero features; documents without a label, or
with a null one, do not train; without labels of both classes the score is
the class share.  Repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import lean, slices
from riskview.llm.subword_classifier import class_weights, sample_of
from riskview.llm.words import Words, words_of

#: Common insults of the four languages, and second-person words.
INSULTS = ("idiot", "moron", "stupid", "dumb", "trash", "scum", "loser", "pathetic", "worthless", "disgusting", "clown",
           "dumm", "dummkopf", "trottel", "abschaum", "widerlich", "idiota", "imbécil", "estúpido", "basura", "escoria",
           "asqueroso", "idiote", "imbécile", "crétin", "ordure", "dégoûtant", "minable")
SECOND_PERSON = ("you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie",
                 "tu", "te", "ti", "tus", "usted", "ustedes", "vosotros", "toi", "ton", "ta", "tes", "vous", "votre", "vos")
NEAR = 5  # words between a hit and a second-person word that count as close

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_STOP = np.isin(_BYTES, [ord(c) for c in ".,;:!?"])
_SHOUT = np.isin(_BYTES, [ord(c) for c in "!?"])
_MARK = (_BYTES > 32) & ~_LETTER & ~_DIGIT & ~_STOP

NAMES = ("lexicon", "stems", "hits", "stem_hits", "second_person", "close", "capitals", "shouted", "stops", "exclaims",
         "marks", "digits", "mixed", "drawn_out", "word_size", "words")


@dataclass(frozen=True)
class Training:
    """Parameters of the fit; ``per_class`` is the most labelled documents of
    each class it takes, ``stem`` the bytes of a stem."""

    per_class: int = 4000
    stem: int = 4
    least_docs: int = 4
    least_odds: float = 8.0
    trees: int = 60
    depth: int = 3
    bins: int = 32
    rate: float = 0.15


@dataclass
class Lexicon:
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    stems: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))


def _cores(words: Words) -> tuple[Words, Words, np.ndarray]:
    """Words without marks at their ends, their stems, and which words are
    long enough to have one."""
    start, end = words.start.copy(), words.end.copy()
    for _ in range(4):
        end -= (end > start + 1) & ~(_LETTER | _DIGIT)[words.data[end - 1]]
        start += (end > start + 1) & ~(_LETTER | _DIGIT)[words.data[start]]
    core = Words(words.data, start, end, words.doc, words.first)
    return core, core, end - start


def _codes(words: Words, stem: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words' cores and of their stems (0: no longer than one)."""
    core, _, size = _cores(words)
    cut = Words(core.data, core.start, np.minimum(core.end, core.start + stem), core.doc, core.first)
    return core.codes(), np.where(size > stem, cut.codes(), np.uint64(0))


def fixed_codes(items: tuple[str, ...]) -> np.ndarray:
    return np.sort(_codes(words_of(pa.array([" ".join(items)]), lower=True), 4)[0])


def _is_in(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(codes), dtype=bool)
    return table[np.minimum(np.searchsorted(table, codes), len(table) - 1)] == codes


def features(texts: pa.Array, lexicon: Lexicon, second: np.ndarray, stem: int) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    n = len(texts)
    raw, low = words_of(texts), words_of(texts, lower=True)
    count = lambda doc, w=None: np.bincount(doc, weights=w, minlength=n).astype(float)
    words = np.maximum(raw.per_doc, 1)
    out = np.zeros((n, len(NAMES)))
    if not len(raw.start):
        return out
    code, root = _codes(low, stem)
    hit, root_hit = _is_in(code, lexicon.words), _is_in(root, lexicon.stems)
    you = _is_in(code, second)
    near = np.zeros(len(code), dtype=bool)
    for k in range(1, NEAR + 1):
        near[k:] |= you[:-k] & (raw.doc[k:] == raw.doc[:-k])
        near[:-k] |= you[k:] & (raw.doc[k:] == raw.doc[:-k])
    size = raw.end - raw.start
    sums = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[raw.data])))[np.stack((raw.start, raw.end))], axis=0)[0]
    letters, uppers, digits, marks = sums(_LETTER), sums(_UPPER), sums(_DIGIT), sums(_MARK)
    core = _cores(low)[0]
    inner = np.concatenate(([0], np.cumsum((_DIGIT | _MARK)[raw.data])))
    mixed = (letters > 0) & (inner[core.end] - inner[core.start] > 0)
    same = np.zeros(len(raw.data) + 1, dtype=np.int64)
    if len(raw.data) > 2:
        d = low.data
        same[3:] = np.cumsum((d[2:] == d[1:-1]) & (d[1:-1] == d[:-2]) & _LETTER[d[2:]])
    drawn = (size > 2) & (same[raw.end] - same[np.minimum(raw.start + 2, raw.end)] > 0)
    long = count(raw.doc, size)
    chars = np.maximum(long, 1)
    hits, root_hits = count(raw.doc, hit), count(raw.doc, root_hit)
    cols = (hits / words, root_hits / words, hits, root_hits, count(raw.doc, you) / words,
            count(raw.doc, near & (hit | root_hit)), count(raw.doc, uppers) / chars,
            count(raw.doc, (uppers > 1) & (uppers == letters)) / words, count(raw.doc, sums(_STOP)) / words,
            count(raw.doc, sums(_SHOUT)) / words, count(raw.doc, marks) / chars, count(raw.doc, digits) / chars,
            count(raw.doc, mixed) / words, count(raw.doc, drawn) / words, long / words, raw.per_doc.astype(float))
    return np.stack(cols, axis=1)


def _typical(stem: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct word and stem codes of every labelled text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text"):
                words = words_of(few.column("text"), lower=True)
                code, root = _codes(words, stem)
                labels = few.column("label").to_numpy(zero_copy_only=False)
                for kind, values in ((0, code), (1, root)):
                    used = values != 0
                    pairs = np.unique(np.stack((words.doc[used].astype(np.uint64), values[used])), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(pairs.shape[1], kind), pa.int32()), pa.array(pairs[1].view(np.int64)),
                         pa.array(labels[pairs[0].astype(np.int64)], pa.int32())], names=["kind", "code", "label"])
    return run


@dataclass
class Trees:
    """Boosted depth-wise trees: per level a feature and a cut for each node."""

    base: float
    cuts: list[np.ndarray]
    features: list[list[np.ndarray]]
    bins: list[list[np.ndarray]]
    leaves: list[np.ndarray]

    def odds(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feats, bins, leaf in zip(self.features, self.bins, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for f, b in zip(feats, bins):
                node = 2 * node + (binned[rows, f[node]] > b[node])
            out += leaf[node]
        return out


def grow(x: np.ndarray, y: np.ndarray, t: Training, weight: np.ndarray | None = None) -> Trees:
    """Newton boosting of the weighted logistic loss over feature histograms."""
    weight = np.ones(len(y)) if weight is None else weight
    share = ((weight * y).sum() + 0.5) / (weight.sum() + 1)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, t.bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    trees = Trees(float(np.log(share / (1 - share))), cuts, [], [], [])
    z = np.full(len(y), trees.base)
    for _ in range(t.trees):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        node, feats, bins = np.zeros(len(y), dtype=np.int64), [], []
        for level in range(t.depth):
            nodes = 1 << level
            best_gain, best_f, best_b = np.zeros(nodes), np.zeros(nodes, dtype=np.int64), np.full(nodes, t.bins)
            for j in range(x.shape[1]):
                key = node * (t.bins + 1) + binned[:, j]
                left = [np.cumsum(np.bincount(key, weights=w, minlength=nodes * (t.bins + 1)).reshape(nodes, -1), axis=1)
                        for w in (g, h)]
                (gl, hl), gt, ht = left, left[0][:, -1:], left[1][:, -1:]
                gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                gain[(hl < 0.5) | (ht - hl < 0.5)] = 0
                b = gain.argmax(axis=1)
                own = gain[np.arange(nodes), b]
                better = own > best_gain + 1e-9
                best_gain[better], best_f[better], best_b[better] = own[better], j, b[better]
            feats.append(best_f)
            bins.append(best_b)
            node = 2 * node + (binned[np.arange(len(y)), best_f[node]] > best_b[node])
        leaves = 1 << t.depth
        leaf = -t.rate * np.bincount(node, weights=g, minlength=leaves) / (np.bincount(node, weights=h, minlength=leaves) + 1)
        z += leaf[node]
        trees.features.append(feats)
        trees.bins.append(bins)
        trees.leaves.append(leaf)
    return trees


def isotonic(z: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of the best rising step function, each
    pool's share smoothed by a tenth of a document of either class.  Equal
    ``z`` are one pool from the start, so the order of rows does not matter."""
    weight = np.ones(len(y)) if weight is None else weight
    steps, at = np.unique(z, return_inverse=True)
    pools: list[list[float]] = []  # ones, size, first z, last z
    for v, one, size in zip(steps.tolist(), np.bincount(at, weights=weight * y).tolist(), np.bincount(at, weights=weight).tolist()):
        pools.append([one, size, v, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    knots = [(e, (p[0] + 0.1) / (p[1] + 0.2)) for p in pools for e in ((p[2], p[3]) if p[3] > p[2] else (p[2],))]
    share = np.maximum.accumulate([k[1] for k in knots])
    return np.array([k[0] for k in knots]), share


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: np.ndarray
    shares: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.shares[0])
        return np.interp(self.trees.odds(x), self.knots, self.shares)


def fit(docs: DataFrame, labels: DataFrame, label: str, t: Training, id_col: str, text_col: str) -> Model:
    """A model from at most ``t.per_class`` labelled documents of each class."""
    known = sample_of(labels, label, t.per_class, id_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    train = (rows.join(F.broadcast(known), "id").groupBy("id")  # an id counts once
             .agg(F.max("label").alias("label"), F.min("text").alias("text"))
             .withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(20))))
    teach, grown = train.where("part < 9"), train.where("part >= 9")
    size = {r["label"]: r["n"] for r in teach.groupBy("label").agg(F.count("*").alias("n")).collect()}
    seen = teach.select("label", "text").mapInArrow(lean(_typical(t.stem)), "kind int, code long, label int")
    odds = ((F.col("bad") + 0.05) / (size.get(1, 0) + 1)) / ((F.col("good") + 0.05) / (size.get(0, 0) + 1))
    seen = (seen.groupBy("kind", "code").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
            .where((F.col("bad") >= t.least_docs) & (odds >= t.least_odds)).toPandas())
    found = [np.sort(seen.loc[seen["kind"] == k, "code"].to_numpy().astype(np.int64).view(np.uint64)) for k in (0, 1)]
    lexicon = Lexicon(np.unique(np.concatenate((found[0], fixed_codes(INSULTS)))), found[1])
    second = fixed_codes(SECOND_PERSON)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text"):
                x = features(few.column("text"), lexicon, second, t.stem)
                yield pa.RecordBatch.from_arrays([few.column("id"), few.column("part"), few.column("label"),
                                                  pa.array(list(x), pa.list_(pa.float64()))], names=["id", "part", "label", "x"])

    kind = train.schema["id"].dataType.simpleString()
    table = grown.select("id", "part", "label", "text").mapInArrow(
        run, f"id {kind}, part long, label int, x array<double>").toPandas().sort_values("id", ignore_index=True)
    y = table["label"].to_numpy().astype(float)
    weight = np.array(class_weights(labels, label, t.per_class, id_col))[y.astype(int)]  # a capped class counts for all its labels
    if len(set(y)) < 2:
        return Model(lexicon, None, np.zeros(1), np.array([(y.sum() + 0.5) / (len(y) + 1)]))
    x, part = np.stack(table["x"].to_list()), table["part"].to_numpy()
    last = part >= 16
    if len(set(y[~last])) < 2 or len(set(y[last])) < 2:
        last = np.ones(len(y), dtype=bool)
        trees = grow(x, y, t, weight)
    else:
        trees = grow(x[~last], y[~last], t, weight[~last])
    return Model(lexicon, trees, *isotonic(trees.odds(x[last]), y[last], weight[last]))


def classify(docs: DataFrame, labels: DataFrame, label: str, out: Column, t: Training = Training(),
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every document: id, held_out, score, predicted.

    ``labels`` holds id and ``label``; ``out`` (over the id column) marks ids
    whose labels are not learned from."""
    model = fit(docs, labels.where(~out), label, t, id_col, text_col)
    second = fixed_codes(SECOND_PERSON)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), out.alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text"):
                score = model.score(features(few.column("text"), model.lexicon, second, t.stem))
                yield pa.RecordBatch.from_arrays([few.column("id"), few.column("held_out"), pa.array(score, pa.float64())],
                                                 names=["id", "held_out", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(lean(run), f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def filter_clean(docs: DataFrame, model: Model, t: Training = Training(), text_col: str = "text") -> DataFrame:
    """The documents, all columns, that ``model`` does not predict toxic."""
    second = fixed_codes(SECOND_PERSON)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, text_col):
                score = model.score(features(few.column(few.schema.get_field_index(text_col)), model.lexicon, second, t.stem))
                yield few.filter(pa.array(score < 0.5))

    return docs.mapInArrow(lean(run), docs.schema)
