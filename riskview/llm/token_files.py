"""Token-id files with Elias-Fano document boundaries.

A shard is one binary value: a fixed header, the ids of its documents as one
little-endian array of 16 or 32 bits, the boundaries of the documents in that
array, and the documents' ids.  Boundaries (and ids, which are in order too)
are Elias-Fano coded: the low ``l`` bits of each value in a packed array, the
high bits in unary, plus the position of every 256th one bit.  ``select(i)``
finds a boundary from the nearest sample, so offsets need about
``2 + log2(ids / documents)`` bits each instead of a 64-bit table.

Plan.  Documents are range-partitioned and sorted by id (a row number breaks
ties, so equal rows spread too), encoded where they land, and the shards are
written through Spark's own writer: its commit makes retries of lost tasks
safe and any store that Spark writes will do.  A shard's place in the whole
array is the running sum of the shard sizes (one row a shard).

Cases: null or empty text has no ids but its end id; null document ids come
first and stay null; repeated ids keep separate entries; an empty table gives
no shards.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskview.llm.common import parts_for, slices, text_bytes
from riskview.llm.words import words_of
from riskview.operators.joins import broadcast_if_small

_SAMPLE = 256
_HEAD = struct.Struct("<4sBQQQq")  # magic, id width, documents, ids, null document ids, smallest document id
_MAGIC = b"EFT1"


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel())
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits), ones[::_SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        parts = (self.low.tobytes(), self.high.tobytes(), self.samples.tobytes())
        return struct.pack("<QBQQQ", self.count, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def read(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, a, b, c = struct.unpack_from("<QBQQQ", raw, at)
        at += struct.calcsize("<QBQQQ")
        low = np.frombuffer(raw, np.uint8, a, at)
        high = np.frombuffer(raw, np.uint8, b, at + a)
        return cls(n, low_bits, low, high, np.frombuffer(raw, np.uint32, c // 4, at + a + b)), at + a + b + c

    def _lows(self, first: int, n: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(n, dtype=np.uint64)
        lo, hi = first * self.low_bits, (first + n) * self.low_bits
        bits = np.unpackbits(self.low[lo // 8:(hi + 7) // 8])[lo % 8:lo % 8 + hi - lo]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(n, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sampled one bit."""
        at = int(self.samples[i // _SAMPLE])
        want, byte = i % _SAMPLE, at // 8
        while True:  # few bytes: a sample every 256 ones
            step = 64
            bits = np.unpackbits(self.high[byte:byte + step])
            if byte == at // 8:
                bits[:at % 8] = 0
            ones = np.flatnonzero(bits)
            if want < len(ones):
                high = byte * 8 + int(ones[want]) - i
                return (high << self.low_bits) | int(self._lows(i, 1)[0])
            want, byte = want - len(ones), byte + step

    def values(self) -> np.ndarray:
        """All values."""
        high = np.flatnonzero(np.unpackbits(self.high))[:self.count] - np.arange(self.count)
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(0, self.count)


def pack_shard(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """Documents (null ids first, then ascending) as one shard."""
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    least = known[0] if known else 0
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    return b"".join((
        _HEAD.pack(_MAGIC, width, len(ids), int(bounds[-1]), nulls, least),
        flat.astype(f"<u{width}").tobytes(), EliasFano.of(bounds).to_bytes(),
        EliasFano.of(np.array([d - least for d in known], dtype=np.uint64)).to_bytes()))


def unpack_shard(raw: bytes) -> tuple[list[int | None], np.ndarray, EliasFano]:
    """Document ids, the id array and the document boundaries of a shard."""
    magic, width, n, total, nulls, least = _HEAD.unpack_from(raw, 0)
    if magic != _MAGIC:
        raise ValueError("not a token shard")
    flat = np.frombuffer(raw, f"<u{width}", total, _HEAD.size)
    bounds, at = EliasFano.read(memoryview(raw), _HEAD.size + total * width)
    known, _ = EliasFano.read(memoryview(raw), at)
    return [None] * nulls + [least + int(x) for x in known.values()], flat, bounds


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return _PACKS[len(ids)](*ids) if len(ids) < len(_PACKS) else struct.pack(f"<{len(ids)}I", *ids)


_PACKS = [struct.Struct(f"<{n}I").pack for n in range(32)]


class WordEncoder:
    """``tokenizers`` encoding with the ids of words remembered.

    Valid for a byte-level tokenizer whose pre-tokeniser drops white space and
    whose normaliser is character-wise (NFC, lower case): a text's ids are then
    those of its blank-separated words, and a run of letters followed by
    punctuation is cut between the two.  Each distinct word of a chunk is
    looked up once; unseen letter runs go straight to the library's BPE model,
    everything else through its whole chain.  The table is bounded.
    """

    #: Letters for which lower case and NFC act on each character alone.
    _letters = "".join(chr(c) for c in range(0x41, 0x250) if chr(c).isalpha() and chr(c) not in "İŉǄǅǆǇǈǉǊǋǌǱǲǳ")
    _marks = b".,;:!?"

    def __init__(self, path: str, most: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._byte = {}
        for c in range(0x80, 0x800):
            (piece, _), = shown.pre_tokenize_str(chr(c))
            self._byte[c] = piece
        if not self._word_wise():
            raise ValueError("this tokenizer is not a word-wise byte-level one")

    def _word_wise(self) -> bool:
        probe = ["Alpha,  beta\n\tgamma.", "it's 12 Übung: x!", "ÉTÉ, maß"]
        whole = [e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        return all(list(self.encode(pa.array([text]))[0]) == ids for text, ids in zip(probe, whole))

    def _whole(self, words: list[str]) -> list[bytes]:
        return [_packed(e.ids)
                for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        known, older, tails = self.known, self.older, self.tails
        tokenize, letters, shown, marks = self.tokenizer.model.tokenize, self._letters, self._byte, self._marks
        rest = []
        for raw in words:
            core = raw.rstrip(marks)
            if core.isalpha():  # ASCII letters
                key = core.lower()
                ids = known.get(key) or older.get(key)
                if ids is None:
                    ids = known[key] = _packed([t.id for t in tokenize(key.decode())])
            else:
                word = core.decode()
                if not word.isalpha() or word.strip(letters):
                    rest.append(raw)
                    continue
                word = word.lower()
                key = word.encode()
                ids = known.get(key) or older.get(key)
                if ids is None:
                    ids = known[key] = _packed([t.id for t in tokenize(word.translate(shown))])
            if len(core) < len(raw):
                tail = raw[len(core):]
                if tail not in tails:
                    tails[tail], = self._whole([tail.decode()])
                ids += tails[tail]
            known[raw] = ids
        if rest:
            known.update(zip(rest, self._whole([r.decode() for r in rest])))

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """Ids of words; a full table becomes the older one, from which words
        still in use move back."""
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        if len(self.tails) > 10_000:
            self.tails.clear()
        known, older = self.known, self.older
        missing = [w for w in words if w not in known]
        if older:
            known.update({w: older[w] for w in missing if w in older})
            missing = [w for w in missing if w not in known]
        if missing:
            self._learn(missing)
        return [known[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's ids begin
        (one more entry at the end)."""
        words = words_of(texts)
        if not len(words.start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        _, where, which = np.unique(words.codes(), return_index=True, return_inverse=True)
        raw = words.data.tobytes()
        distinct = [raw[i:j] for i, j in zip(words.start[where].tolist(), words.end[where].tolist())]
        ids = self._look_up(distinct)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        counts = sizes[which]
        ends = np.cumsum(counts)
        out = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - counts), counts) + np.arange(ends[-1])]
        return out, np.concatenate(([0], ends))[words.first]


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _packer(path: str, end_id: int, width: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, held, docs, ids = TaskContext.get().partitionId(), 0, 0, [], []
        encoder = _encoder(path)

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(docs)], pa.int64()),
                 pa.array([sum(map(len, ids))], pa.int64()), pa.array([pack_shard(docs, ids, width)], pa.binary())],
                names=["part", "seq", "n_docs", "n_ids", "shard"])

        for b in batches:
            for few in slices(b, "text", 2_000_000):
                flat, first = encoder.encode(few.column("text"))
                for d, i, j in zip(few.column("id").to_pylist(), first[:-1], first[1:]):
                    docs.append(d)
                    ids.append(np.append(flat[i:j], np.uint32(end_id)))
                    held += (j - i + 1) * width
                    if held >= shard_bytes:
                        yield flush()
                        seq, held, docs, ids = seq + 1, 0, [], []
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", width: int = 2, shard_bytes: int = 8 << 20,
                      part_bytes: int = 32 << 20) -> None:
    """Encode every text and write the shards under ``path``.

    ``width`` is the bytes of an id (2 holds vocabularies up to 65,536),
    ``part_bytes`` the bytes of text a task takes.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = parts_for(text_bytes(rows, F.col("text")), part_bytes)
    # at least a few tasks for every core, never so many that shards get tiny
    parts = max(parts, min(2 * docs.sparkSession.sparkContext.defaultParallelism, 4 * parts))
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    (ordered.mapInArrow(_packer(tokenizer, end_id, width, shard_bytes),
                        "part int, seq int, n_docs long, n_ids long, shard binary")
     .write.option("compression", "zstd").mode("errorifexists").parquet(path))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for base, raw in zip(b.column("base").to_pylist(), b.column("shard")):
            docs, flat, bounds = unpack_shard(raw.as_buffer().to_pybytes())
            at = bounds.values().astype(np.int64)
            offs = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(base + at[:-1], pa.int64()),
                 pa.ListArray.from_arrays(offs, pa.array(flat.astype(np.int32), pa.int32()))],
                names=["id", "start", "ids"])


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for base, raw in zip(b.column("base").to_pylist(), b.column("shard")):
            docs, flat, bounds = unpack_shard(raw.as_buffer().to_pybytes())
            at = bounds.values().astype(np.int64)
            wide = flat.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(base + at[:-1], pa.int64()), pa.array(np.diff(at), pa.int64()),
                 pa.array([zlib.crc32(wide[i:j]) for i, j in zip(at[:-1], at[1:])], pa.int64())],
                names=["id", "start", "n_tokens", "ids_crc32"])


def _shards(docs_dir: DataFrame) -> DataFrame:
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    base = docs_dir.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return docs_dir.select("part", "seq", "shard").join(broadcast_if_small(base), ["part", "seq"]).select("base", "shard")


def read_token_files(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files: id, start in the whole array, ids."""
    out = _shards(spark.read.parquet(path)).mapInArrow(_reader, "id long, start long, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def digest_token_files(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files: id, start, n_tokens, crc32 of its ids as
    little-endian unsigned 32-bit integers."""
    out = _shards(spark.read.parquet(path)).mapInArrow(
        _digester, "id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)
