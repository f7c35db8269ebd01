"""Vectorised words and rolling hashes over a batch of UTF-8 texts.

A word is a maximal run of bytes outside space, tab, LF, VT, FF and CR.  These
are ASCII, so a byte-level scan of UTF-8 finds the same words as the pattern
``[^\\x20\\x09-\\x0D]+`` does on characters.

Hashes are polynomials over the integers modulo 2**64 with an odd base, so a
prefix sum gives the hash of any span by one subtraction and one product with
the base's inverse power (Rabin-Karp).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

#: Seeds of the byte tables and odd bases, one per hash family.
_BASES = (0x9E3779B97F4A7C17, 0xD1342543DE82EF97)
_TABLES = tuple(np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)
                for seed in (11, 12))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for ``i < n``."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 2**64)):
            a = np.full(size, b, dtype=np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        have = (both[0], both[1])
        if size <= 1 << 21:  # 16 MB each; longer texts are rare
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@dataclass
class Words:
    """Words of a batch: byte spans, the text each is in, words per text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of each text's first word; one more entry at the end

    @property
    def per_doc(self) -> np.ndarray:
        return np.diff(self.first)

    def codes(self, family: int = 0) -> np.ndarray:
        """A 64-bit code of each word."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        base = _BASES[family]
        up, down = powers(base, len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_TABLES[family][self.data] * up[:-1], out=sums[1:])
        code = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix(code + (self.end - self.start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Index of the first word of each window of ``width`` words that
        lies inside one text."""
        n = len(self.start) - width + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.doc[:n] == self.doc[width - 1:])


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words of every text of an Arrow string array; null counts as empty."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(bufs[2], dtype=np.uint8) if n and bufs[2] is not None else np.zeros(0, np.uint8)
    data = raw[offs[0]:offs[-1]]
    offs = offs - offs[0]
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text starts here
    edge[offs] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offs)
    doc = np.repeat(np.arange(n), np.diff(first))
    return Words(data, start, end, doc, first)


def rolling(codes: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive codes (Rabin-Karp)."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(_BASES[family], len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:n])
