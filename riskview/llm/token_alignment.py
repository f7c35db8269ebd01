"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes: A a byte-level BPE, B a sentencepiece model
with byte fallback, both over a space and the text.  The byte offsets at which
tokens of both end cut a document into groups, and two tokens are linked when
their byte ranges overlap.

The ends of either tokenizer are an ascending list.  The shorter list drives:
each of its entries looks for its place in the longer one by exponential steps
from the place of an entry before it, then by binary search in the bracket
found.  Equal entries are the common ends; the difference of the places of two
neighbouring ends is the range of tokens that a token overlaps.  All entries of
a batch gallop in step, from anchors every 4th, 16th, ... entry.

Plan.

* One pass encodes and aligns every whole text.  At a single space between
  other characters either tokenizer begins a token, so a text is cut there
  into units that are encoded on their own; a worker remembers the ids of a
  bounded number of short units.  A long text is aligned in runs of units, so
  that the work space does not grow with the text.
* The links of some pieces are one row: the distinct id pairs with their counts
  and every link's place among them.  Counts are summed over the corpus, partly
  in each task, and each B id's highest is found.
* Every row asks for the counts of its own pairs by a join (a pair's row is
  unique on the count side; a frequent pair asks once a row, not once a link),
  and the documents' sums follow.

Cases: a null or empty text, or one whose tokens do not give its bytes back,
has no tokens, groups or links, and an empty digest; repeated rows and null ids
are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import lean, slices
from riskview.operators.joins import broadcast_if_small
from riskview.session import scratch_path

_CUT = re.compile(r"(?<=\S) (?=\S)")
_RUN = 30_000  # units of a text that are aligned at once
_STRIDE = 4  # keys gallop from the place of every 4th, 16th, ... key
_JOINED = 50  # units that are encoded as one text
_SHORT = 48  # characters of a unit that is remembered
_MARK = "▁"
_SCHEMA = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("slice", pa.int64()), ("keys", pa.list_(pa.int64())),
    ("totals", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("codes", pa.binary())])
_COLUMNS = ("row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slice long, "
            "keys array<long>, totals array<long>, rows array<long>, sizes array<long>, codes binary")


class Vocabulary:
    """The bytes of every token, in one array."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokenizers write bytes: printable bytes
    stand for themselves, the others follow from U+0100 in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, loaded once a worker, and the units remembered."""

    def __init__(self, path_a: str, path_b: str, most: int = 100_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters, names = byte_letters(), self.a.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            known = all(c in letters for c in name)
            tokens[i] = bytes(letters[c] for c in name) if known else name.encode()
        self.bytes_a = Vocabulary(tokens)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = Vocabulary([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
                                   for i, p in enumerate(pieces)])
        self.decimal = Vocabulary([str(i).encode() for i in range(max(len(tokens), len(pieces)))])
        self.most, self.known, self.older = most, ({}, {}), ({}, {})
        # no piece of B goes on over a space, and A's units are those of its whole text
        probe = ["it's a b 12 cd, ef", "We'll see  x\n y Z end", "\tGive me é a l o t of tokens's"]
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces) and all(
            sum((self.a.encode(" " + u, add_special_tokens=False).ids for u in _CUT.split(t)), [])
            == self.a.encode(" " + t, add_special_tokens=False).ids for t in probe)

    def units(self, text: str) -> list[str]:
        """The text in units; a space goes before each."""
        return _CUT.split(text) if self.cuts else [text]

    def learn(self, units: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """The ids of distinct units as packed 32-bit integers, for A and for B;
        units whose bytes are not given back are in neither."""
        out: tuple[dict, dict] = {}, {}
        at = 0
        while at < len(units):  # what the libraries take at once is bounded too
            to, size = at, 0
            while to < len(units) and (to == at or size + len(units[to]) <= 200_000):
                size += len(units[to])
                to += 1
            some, at = units[at:to], to
            if self.cuts:  # joined by single spaces, units are encoded as on their own
                inner = [u for u in some if u and u == u.strip()]
                some = [u for u in some if not u or u != u.strip()] + self._learn_joined(inner, out)
            if not some:
                continue
            a = [x.ids for x in self.a.encode_batch_fast([" " + u for u in some], add_special_tokens=False)]
            b = self.b.encode(some, num_threads=1)
            same = self._same(some, a, b)
            for u, x, y in zip(some, a, b):
                if same or self._same([u], [x], [y]):
                    out[0][u], out[1][u] = array("i", x).tobytes(), array("i", y).tobytes()
        return out

    def _learn_joined(self, units: list[str], out: tuple[dict[str, bytes], dict[str, bytes]]) -> list[str]:
        """``learn`` for units that neither begin nor end with white space,
        many in one text.  Ids must give the text's bytes back, with a token's
        end at every unit's; else the halves are tried, and the units of a
        small rest are returned."""
        if len(units) < 16:
            return units
        texts = [" ".join(units[k:k + _JOINED]) for k in range(0, len(units), _JOINED)]
        a = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        raw = (" " + " ".join(texts)).encode()
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)) + 1)
        cuts = []
        for vocabulary, ids in ((self.bytes_a, a), (self.bytes_b, b)):
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            done = np.cumsum(vocabulary.sizes[flat])
            last = np.searchsorted(done, ends)
            if vocabulary.spell(flat).tobytes() != raw or (done[last] != ends).any():
                half = len(units) // 2
                return self._learn_joined(units[:half], out) + self._learn_joined(units[half:], out)
            cuts.append((flat.tobytes(), [0, *((last + 1) * 4).tolist()]))
        for own, (packed, to) in zip(out, cuts):
            own.update(zip(units, [packed[i:j] for i, j in zip(to, to[1:])]))
        return []

    def _same(self, units: list[str], a: list[list[int]], b: list[list[int]]) -> bool:
        """Whether either tokenizer's ids give every unit back."""
        raw = [(" " + u).encode() for u in units]
        for vocabulary, ids in ((self.bytes_a, a), (self.bytes_b, b)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            if vocabulary.spell(flat).tobytes() != b"".join(raw):
                return False
            sizes = np.concatenate(([0], np.cumsum(vocabulary.sizes[flat])))[np.cumsum([len(x) for x in ids])]
            if sizes.tolist() != np.cumsum([len(r) for r in raw]).tolist():
                return False
        return True

    def encode(self, texts: list[list[str]]) -> list[tuple[bytes, bytes] | None]:
        """Ids of A and B of every run of units; None if its bytes are not given back."""
        if len(self.known[0]) > self.most:  # what is still in use moves back from the older table
            self.known, self.older = ({}, {}), self.known
        (known_a, known_b), (older_a, older_b) = self.known, self.older
        missing = []
        for u in {u for own in texts for u in own if u not in known_a}:
            if u in older_a:
                known_a[u], known_b[u] = older_a[u], older_b[u]
            else:
                missing.append(u)
        new_a, new_b = self.learn([u for u in missing if len(u) <= _SHORT])
        known_a.update(new_a)
        known_b.update(new_b)
        long_a, long_b = self.learn([u for u in missing if len(u) > _SHORT])  # of this call alone
        known_a.update(long_a)
        known_b.update(long_b)
        out = []
        for own in texts:
            try:
                out.append((b"".join(map(known_a.__getitem__, own)), b"".join(map(known_b.__getitem__, own))))
            except KeyError:
                out.append(None)
        for u in long_a:
            del known_a[u], known_b[u]
        return out


def _from(start: np.ndarray, keys: np.ndarray, into: np.ndarray) -> np.ndarray:
    """First index, from ``start`` on, whose entry is not below the key:
    exponential steps, then binary search in the bracket."""
    lo, hi = start.copy(), np.full(len(keys), len(into))
    going, step = np.arange(len(keys)), 1
    while len(going):
        probe = lo[going] + step
        going, probe = going[probe <= len(into)], probe[probe <= len(into)]
        below = into[probe - 1] < keys[going]
        hi[going[~below]] = probe[~below] - 1
        going = going[below]
        lo[going] = probe[below]
        step *= 2
    going = np.flatnonzero(lo < hi)
    while len(going):
        mid = (lo[going] + hi[going]) // 2
        below = into[mid] < keys[going]
        lo[going[below]] = mid[below] + 1
        hi[going[~below]] = mid[~below]
        going = going[lo[going] < hi[going]]
    return lo


def gallop(keys: np.ndarray, into: np.ndarray) -> np.ndarray:
    """For each of the ascending ``keys``, the first index of ``into`` whose
    entry is not below it.  Every key gallops from an earlier key's place."""
    place = np.zeros(len(keys), dtype=np.int64)
    stride = 1
    while stride * _STRIDE < len(keys):
        stride *= _STRIDE
    before = None
    while stride:
        at = np.arange(0, len(keys), stride)
        start = np.zeros(len(at), np.int64) if before is None else place[at // before * before]
        place[at] = _from(start, keys[at], into)
        before, stride = stride, stride // _STRIDE
    return place


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the common ends in both lists, and of the tokens of every
    link; both lists end at the same offset."""
    turned = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if turned else (ends_a, ends_b)
    place = gallop(short, long)
    equal = long[place] == short
    first = np.concatenate(([0], (place + equal)[:-1])) if len(short) else place
    counts = place - first + 1
    done = np.cumsum(counts)
    left = np.repeat(np.arange(len(short)), counts)
    right = np.arange(done[-1] if len(done) else 0) - np.repeat(done - counts - first, counts)
    common = np.flatnonzero(equal), place[equal]
    return (*common[::-1], right, left) if turned else (*common, left, right)


def _group_text(pair: Pair, a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` as bytes, and where each group ends in it."""
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[ia] = last_b[ib] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    ids, marks = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    at_a = np.arange(len(a)) + np.concatenate(([0], ib + 1))[group_a]
    at_b = np.arange(len(b)) + (ia + 1)[group_b]
    ids[at_a], ids[at_b] = a, b
    marks[at_a], marks[at_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
    sizes = pair.decimal.sizes[ids]
    ends = np.cumsum(sizes + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[ends - 1], out[inner] = marks, pair.decimal.spell(ids)
    return out, ends[at_b[ib]]


_pairs: dict[tuple[str, str], Pair] = {}


def _aligner(path_a: str, path_b: str, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def documents(pair: Pair, base: int, batches: Iterator[pa.RecordBatch]):
        """Row number, id and the encoded runs of every text."""
        row = base
        for b in batches:
            for few in slices(b, "text", most):
                texts = [pair.units(t) if t else [] for t in few.column("text").to_pylist()]
                runs = [[own[k:k + _RUN] for k in range(0, len(own), _RUN)] for own in texts]
                coded = iter(pair.encode([r for own in runs for r in own]))
                for i, own in zip(few.column("id").to_pylist(), runs):
                    both = [next(coded) for _ in own]
                    yield row, i, [] if None in both else [tuple(np.frombuffer(x, np.int32) for x in r) for r in both]
                    row += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pair = _pairs.get((path_a, path_b)) or _pairs.setdefault((path_a, path_b), Pair(path_a, path_b))
        base = TaskContext.get().partitionId() << 40
        number, held, tokens = base, [], 0  # held: pieces not yet aligned, as (document, a, b)

        def flush() -> Iterator[dict]:
            nonlocal number, held, tokens
            yield from _align(pair, number, held)
            number, held, tokens = number + 1, [], 0

        def rows() -> Iterator[dict]:
            nonlocal tokens
            for row, i, own in documents(pair, base, batches):
                doc = {"row": row, "id": i, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "left": len(own),
                       "sha": hashlib.sha256() if own else None}
                if not own:
                    yield _finished(doc)
                for a, b in own:
                    held.append((doc, a, b))
                    tokens += len(a) + len(b)
                    if tokens > most:
                        yield from flush()
            if held:
                yield from flush()

        few, size = [], 0
        for r in rows():
            few.append(r)
            size += 100 + len(r.get("codes", b""))
            if size > 4 * most:
                yield pa.RecordBatch.from_pylist(few, _SCHEMA)
                few, size = [], 0
        if few:
            yield pa.RecordBatch.from_pylist(few, _SCHEMA)
    return run


def _finished(doc: dict) -> dict:
    out = {k: doc[k] for k in ("row", "id", "n_a", "n_b", "n_groups", "n_links")}
    return out | {"groups_sha256": doc["sha"].hexdigest() if doc["sha"] else ""}


def _align(pair: Pair, number: int, held: list[tuple[dict, np.ndarray, np.ndarray]]) -> Iterator[dict]:
    """Align some pieces as one pair of lists; the documents that are complete
    and one row of links."""
    a, b = np.concatenate([x for _, x, _ in held]), np.concatenate([y for _, _, y in held])
    ends_a, ends_b = np.cumsum(pair.bytes_a.sizes[a]), np.cumsum(pair.bytes_b.sizes[b])
    ia, ib, link_a, link_b = overlaps(ends_a, ends_b)
    text, group_ends = _group_text(pair, a, b, ia, ib)
    # the pieces end at common ends: cut groups and links there
    to_a = np.cumsum([len(x) for _, x, _ in held])
    groups = np.searchsorted(ia, to_a - 1) + 1
    links = np.searchsorted(link_a, to_a)
    bytes_to = group_ends[groups - 1]
    keys, codes, totals = np.unique(a[link_a].astype(np.int64) << 32 | b[link_b], return_inverse=True, return_counts=True)
    sizes: dict[int, int] = {}
    g0 = l0 = t0 = 0
    done = []
    for (doc, x, y), g, n, t in zip(held, groups.tolist(), links.tolist(), bytes_to.tolist()):
        doc["n_a"] += len(x)
        doc["n_b"] += len(y)
        doc["n_groups"] += g - g0
        doc["n_links"] += n - l0
        doc["left"] -= 1
        doc["sha"].update(text[t0:t if doc["left"] else t - 1].tobytes())  # no mark after the last group
        sizes[doc["row"]] = sizes.get(doc["row"], 0) + n - l0
        g0, l0, t0 = g, n, t
        if not doc["left"]:
            done.append(_finished(doc))
    yield from done
    yield {"slice": number, "keys": keys, "totals": totals, "rows": list(sizes), "sizes": list(sizes.values()),
           "codes": codes.astype("<i4").tobytes()}


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that are their B id's best and the sum of the counts, a document."""
    for b in batches:
        for k in range(b.num_rows):
            counts = b.column("counts")[k].values
            n, best = (counts.field(f).to_numpy(zero_copy_only=False) for f in ("n", "best"))
            codes = np.frombuffer(b.column("codes")[k].as_buffer(), "<i4")
            at = np.cumsum([0, *b.column("sizes")[k].as_py()])
            sums = [np.concatenate(([0], np.cumsum(x[codes].astype(np.int64))))[at] for x in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column("rows")[k].values, *[pa.array(np.diff(s)) for s in sums]], names=["row", "n_best", "count_sum"])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          most: int = 1_000_000) -> DataFrame:
    """Alignment of both tokenizers' tokens of every text: id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256.

    ``path_a`` names a byte-level tokenizers file, ``path_b`` a sentencepiece
    model that adds a space; ``most`` is the bytes of text encoded, and the
    tokens aligned, at once."""
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows.mapInArrow(lean(_aligner(path_a, path_b, most)), _COLUMNS).write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(_COLUMNS).parquet(path)
    links = table.where("slice IS NOT NULL")
    asked = links.select("slice", F.explode(F.arrays_zip("keys", "totals")).alias("k")).select("slice", "k.keys", "k.totals")
    counts = asked.groupBy(F.col("keys").alias("key")).agg(F.sum("totals").alias("n"))
    counts = counts.withColumn("b", F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)))
    path = scratch_path(spark, "alignment-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))  # as many rows as B has ids
    counts = counts.join(broadcast_if_small(highest), "b").select("key", "n", (F.col("n") == F.col("highest")).cast("long").alias("best"))
    known = asked.join(broadcast_if_small(counts), F.col("keys") == F.col("key"))
    # one row a slice: its distinct pairs, in the order of their codes
    known = known.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("key", "n", "best"))).alias("counts"))
    sums = (links.select("slice", "rows", "sizes", "codes").join(known, "slice")
            .mapInArrow(lean(_sums), "row long, n_best long, count_sum long")
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    out = table.where("slice IS NULL").join(sums, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
                      F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
