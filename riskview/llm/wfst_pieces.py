"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model is compiled into three transducers.  The normaliser escapes spaces and
adds the leading mark; the piece transducer is a trie that reads characters
and writes a piece; byte fallback maps any character no piece has to its
bytes.  An input is composed with them from left to right, and its encoding is
the shortest path in the tropical semiring.

For a unigram model an arc weighs minus the piece's score.  A byte-pair model
has no additive weights: there the bigram constraint carries the semantics.
An arc may follow another only if merging their two pieces' characters alone
gives back just these pieces; other successions weigh infinity.  A text's
byte-pair encoding is the one path on which every neighbouring pair is allowed
(merges are local, so a merge across a boundary would show in that pair), and
every prefix has one such path too, so the composition has one live state for
each position and its shortest path is found lazily.  Results equal the
library's.  The searches of a batch's parts advance in step, over arrays.

Whole texts are cut at marks and at neighbouring characters that no piece
holds, as no path crosses there; the segments of a chunk are looked up once
each in a bounded table.

Cases: null or empty text has no ids and decodes to an empty text; characters
outside the vocabulary become bytes; repeated rows encode alike; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import lean, slices
from riskview.llm.words import Words

MARK = "▁"
_LONG = 32  # characters from which a part is searched on its own and not remembered
_TOGETHER = 2_500  # parts searched in step
_RUNS = re.compile(rf"{MARK}*\w+|{MARK}+|[^\w{MARK}]")


class Transducer:
    """The compiled model."""

    def __init__(self, path: str, most: int = 80_000):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only identity normalisers that keep white space are compiled")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("marks after words are not compiled")
        kinds = type(model.pieces[0]) if model.pieces else None
        self.prefix = spec.add_dummy_prefix
        self.merges = model.trainer_spec.model_type == 2
        self.pieces = [p.piece for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN), 0)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        usual = (kinds.NORMAL, kinds.USER_DEFINED)
        self.number = {p.piece: i for i, p in enumerate(model.pieces) if p.type in usual}
        self.score = {p.piece: p.score for p in model.pieces if p.type in usual}
        self.least = min(self.score.values(), default=0.0)
        # states of the piece transducer: one table of (state, character) -> state, and the piece a state ends
        self.next: dict[tuple[int, str], int] = {}
        self.ends: list[int] = [-1]
        for piece, i in self.number.items():
            state = 0
            for c in piece:
                to = self.next.setdefault((state, c), len(self.ends))
                if to == len(self.ends):
                    self.ends.append(-1)
                state = to
            self.ends[state] = i
        self.joined = {a + b for piece in self.number for a, b in zip(piece, piece[1:])}
        if any(MARK in piece.lstrip(MARK) for piece in self.number):
            raise ValueError("a piece holds a mark after other characters")
        self.surface = [bytes((int(p[3:5], 16),)) if k == kinds.BYTE else b"" if k == kinds.CONTROL
                        else b" \xe2\x81\x87 " if k == kinds.UNKNOWN else p.replace(MARK, " ").encode()
                        for p, k in zip(self.pieces, self.kind)]
        self.allowed: dict[int, bool] = {}  # by (first piece + 1) * 2**32 + second piece
        #: Control characters that no piece holds: segments end there.
        self.cuts = np.array([c < 0x20 and not any(chr(c) in p for p in self.number) for c in range(256)])
        #: Characters that are pieces, and a pattern that tells runs of them from others.
        self.single = {c for c in self.number if len(c) == 1}
        self.runs = re.compile("([" + "".join(map(re.escape, sorted(self.single))) + "]+)|(.)", re.S) if self.single \
            else re.compile("()(.)", re.S)
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.most = most
        # the same table and what is known of successions, as arrays for many searches at once
        wide = max((ord(c) for _, c in self.next), default=0) + 1
        self.first = np.zeros(wide + 1, np.int64)  # from the first state; the last entry stands for all other characters
        for (state, c), to in self.next.items():
            if not state:
                self.first[ord(c)] = to
        arcs = np.array([(state << 21 | ord(c), to) for (state, c), to in self.next.items()], np.int64).reshape(-1, 2)
        self.arc_keys, self.arc_to = arcs[np.argsort(arcs[:, 0])].T.copy()
        self.end_of = np.array(self.ends, np.int64)
        self.pair_keys, self.pair_ok = np.full(1 << 19, -1, np.int64), np.zeros(1 << 19, bool)

    # the bigram constraint of byte-pair models

    def _crosses(self, text: str, wall: int) -> list[str] | None:
        """Merge best-scored neighbours; None once a merge crosses ``wall``."""
        parts, score, none = list(text), self.score.get, -math.inf
        ends = list(range(1, len(parts) + 1))
        scores = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            if ends[i] == wall:
                return None
            parts[i] += parts.pop(i + 1)
            del ends[i], scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def _merge_free(self, u: int, v: int) -> bool:
        """Whether piece ``v`` may follow ``u`` (-1: the segment's start)."""
        a = self.pieces[u] if u >= 0 else ""
        b = self.pieces[v]
        return self._crosses(a + b, len(a)) == ([a, b] if a else [b])

    def _follows(self, u: int, v: int) -> bool:
        """``_merge_free``, remembered."""
        if len(self.allowed) > 120_000:
            self.allowed.clear()
        ok = self.allowed[(u + 1 << 32) + v] = self._merge_free(u, v)
        return ok

    def _arcs(self, text: str, at: int) -> list[tuple[int, int]]:
        """Arcs of the piece transducer from position ``at``: (end, piece)."""
        state, out, step, ends = 0, [], self.next, self.ends
        for j in range(at, len(text)):
            state = step.get((state, text[j]))
            if state is None:
                break
            if ends[state] >= 0:
                out.append((j + 1, ends[state]))
        return out

    def _allowed_path(self, text: str) -> list[int]:
        """The path of a byte-pair model.  Every state but those on it is a
        dead end, so states are expanded lazily, longest arc first, and a
        state found dead is never entered again."""
        allowed, follows, arcs = self.allowed, self._follows, self._arcs
        at, last, n = 0, -1, len(text)
        ids: list[int] = []
        stack: list[tuple[int, int, list[tuple[int, int]]]] = []
        dead = set()
        open_ = arcs(text, 0)
        while at < n:
            while open_:
                j, v = open_.pop()
                if j not in dead and (ok if (ok := allowed.get((last + 1 << 32) + v)) is not None else follows(last, v)):
                    stack.append((at, last, open_))
                    ids.append(v)
                    at, last, open_ = j, v, arcs(text, j)
                    break
            else:
                dead.add(at)
                at, last, open_ = stack.pop()
                ids.pop()
        return ids

    def _all_arcs(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arcs from every position, none over the end of its part: lengths and
        pieces by position, the longest last, and each position's first arc
        (one more entry at the end)."""
        at = np.arange(len(codes))
        state = self.first[np.minimum(codes, len(self.first) - 1)]
        found, length = [], 1
        while True:
            on = state > 0
            at, state = at[on], state[on]
            if not len(at):
                break
            piece = self.end_of[state]
            ending = piece >= 0
            found.append((at[ending], np.full(np.count_nonzero(ending), length), piece[ending]))
            on = at + length < ends[at]
            at, state = at[on], state[on]
            keys = state << 21 | codes[at + length]
            place = np.minimum(np.searchsorted(self.arc_keys, keys), len(self.arc_keys) - 1)
            state = np.where(self.arc_keys[place] == keys, self.arc_to[place], 0)
            length += 1
        where, sizes, pieces = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        order = np.argsort(where, kind="stable")
        return sizes[order], pieces[order], np.searchsorted(where[order], np.arange(len(codes) + 1))

    def _may_follow(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """``_follows`` of many pairs; the latest answer of each place is kept."""
        keys = u + 1 << 32 | v
        slots = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)).view(np.int64)
        ok = self.pair_ok[slots]
        new = np.flatnonzero(self.pair_keys[slots] != keys)
        if len(new):
            asked, which = np.unique(keys[new], return_inverse=True)
            answers = np.array([self._merge_free((k >> 32) - 1, k & 0xFFFFFFFF) for k in asked.tolist()])
            ok[new] = answers[which]
            # pairs that share a place: the last one written has both entries
            self.pair_keys[slots[new]] = keys[new]
            self.pair_ok[slots[new]] = ok[new]
        return ok

    def _allowed_paths(self, texts: list[str]) -> list[bytes]:
        """``_path`` of many short parts of a byte-pair model, as packed ids:
        ``_allowed_path`` of all of them, one arc each a step."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        base = np.cumsum(sizes) - sizes
        arc_size, arc_piece, first = self._all_arcs(codes, np.repeat(base + sizes, sizes))
        # a position whose first arc is one character long is a piece's character
        single = np.zeros(len(codes), bool)
        some = np.flatnonzero(first[1:] > first[:-1])
        single[some] = arc_size[first[some]] == 1
        plain = np.logical_and.reduceat(single, base)
        n = len(texts)
        ids, was_at, was_arc = (np.zeros((n, _LONG + 1), np.int64) for _ in range(3))
        at, depth, dead, last = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1)
        arc = first[base + 1].copy()
        going = np.flatnonzero(plain)
        while len(going):
            open_ = arc[going] > first[base[going] + at[going]]
            back = going[~open_]
            if len(back):  # dead ends
                dead[back] |= 1 << at[back]
                depth[back] -= 1
                if depth[back].min() < 0:
                    raise ValueError("a part has no path")
                at[back], arc[back] = was_at[back, depth[back]], was_arc[back, depth[back]]
                last[back] = np.where(depth[back] > 0, ids[back, depth[back] - 1], -1)
            on = going[open_]
            arc[on] -= 1
            v, to = arc_piece[arc[on]], at[on] + arc_size[arc[on]]
            ok = np.flatnonzero(dead[on] >> to & 1 == 0)
            ok = ok[self._may_follow(last[on[ok]], v[ok])]
            on, v, to = on[ok], v[ok], to[ok]
            was_at[on, depth[on]], was_arc[on, depth[on]], ids[on, depth[on]] = at[on], arc[on], v
            depth[on] += 1
            at[on], last[on] = to, v
            on = on[to < sizes[on]]
            arc[on] = first[base[on] + at[on] + 1]
            going = going[at[going] < sizes[going]]
        flat = ids[np.arange(_LONG + 1) < depth[:, None]].astype("<u4").tobytes()
        ends = (np.cumsum(depth) * 4).tolist()
        out = [flat[i:j] for i, j in zip([0, *ends], ends)]
        for k in np.flatnonzero(~plain).tolist():
            path = self._path(texts[k])
            out[k] = struct.pack(f"<{len(path)}I", *path)
        return out

    def _cheapest_path(self, text: str) -> list[int]:
        """The path of least weight of a unigram model; a character that is no
        piece costs more than any piece and becomes bytes."""
        n = len(text)
        cost = [0.0] + [math.inf] * n
        back: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
        for i in range(n):
            arcs = [(j, -self.score[self.pieces[v]], [v]) for j, v in self._arcs(text, i)]
            if text[i] not in self.single:
                arcs.append((i + 1, 10 - self.least, self._bytes_of(text[i])))
            for j, w, ids in arcs:
                if cost[i] + w < cost[j]:
                    cost[j], back[j] = cost[i] + w, (i, ids)
        out: list[int] = []
        while n:
            n, ids = back[n]
            out = ids + out
        return out

    def _bytes_of(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]

    def _path(self, text: str) -> list[int]:
        if not self.merges:
            return self._cheapest_path(text)
        if self.single.issuperset(text):
            return self._allowed_path(text)
        ids: list[int] = []  # a character that is no piece merges with nothing
        for run, char in re.findall(self.runs, text):
            ids += self._allowed_path(run) if run else self._bytes_of(char)
        return ids

    def _cut(self, text: str) -> str | list[str]:
        """Parts of a marked segment, cut where a letter run ends and no piece
        holds the two neighbours; the text itself if it stays whole."""
        words = _RUNS.findall(text)
        if len(words) == 1:
            return text
        out, part, joined = [], "", self.joined
        for word in words:
            if part and part[-1] + word[0] not in joined:
                out.append(part)
                part = word
            else:
                part += word
        return [*out, part] if out else part

    def _segments_ids(self, segments: list[str]) -> list[bytes]:
        """Packed ids of distinct segments; unknown parts are searched together."""
        known, older = self.parts, self.old_parts
        cut = [s if s in known else self._cut(s) for s in segments]
        lists = [own for own in cut if own.__class__ is list]
        missing = []
        for part in {own for own in cut if own.__class__ is str}.union(*lists).difference(known):
            ids = older.get(part)
            if ids is None:
                missing.append(part)
            else:
                known[part] = ids
        short = [p for p in missing if len(p) < _LONG] if self.merges else []
        for k in range(0, len(short), _TOGETHER):  # bounds the work space
            known.update(zip(short[k:k + _TOGETHER], self._allowed_paths(short[k:k + _TOGETHER])))
        once = {}  # parts of this call alone
        for part in missing:
            if part not in known:
                path = self._path(part)
                (known if len(part) < _LONG else once)[part] = struct.pack(f"<{len(path)}I", *path)
        if once:
            known = known | once
        return [known[own] if own.__class__ is str else b"".join([known[p] for p in own]) for own in cut]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's ids begin
        (one more entry at the end)."""
        head = MARK if self.prefix else ""
        marked = [(head + t.replace(" ", MARK)).encode() if t else b"" for t in texts.to_pylist()]
        spans = _segments(marked, self.cuts)
        if not len(spans.start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        _, where, which = np.unique(spans.codes(), return_index=True, return_inverse=True)
        raw = spans.data.tobytes()
        distinct = [raw[i:j] for i, j in zip(spans.start[where].tolist(), spans.end[where].tolist())]
        if len(self.parts) > self.most:  # from the older table, parts still in use move back
            self.parts, self.old_parts = {}, self.parts
        ids = self._segments_ids([w.decode() for w in distinct])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        counts = sizes[which]
        ends = np.cumsum(counts)
        out = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - counts), counts) + np.arange(ends[-1])]
        return out, np.concatenate(([0], ends))[spans.first]

    def forget(self) -> None:
        """Drop what encoding has remembered."""
        self.parts, self.old_parts, self.allowed = {}, {}, {}

    def decode(self, ids: np.ndarray) -> str:
        """The text whose ids these are: pieces to text, bytes joined."""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        if self.prefix and raw[:1] == b" " and (not len(ids) or ids[0] not in self.bytes.values()):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _segments(marked: list[bytes], cuts: np.ndarray) -> Words:
    """Cut marked texts before each run of marks and around the bytes of
    ``cuts``."""
    data = np.frombuffer(b"".join(marked), dtype=np.uint8)
    offs = np.concatenate(([0], np.cumsum([len(m) for m in marked], dtype=np.int64)))
    n = len(data)
    mark = np.zeros(n + 3, dtype=bool)
    if n > 2:
        mark[:n - 2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    control = cuts[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offs] = True
    at = np.flatnonzero(mark[:n])
    cut[at] |= ~((at >= 3) & mark[np.maximum(at - 3, 0)])
    at = np.flatnonzero(control)
    cut[at] = True
    cut[at + 1] = True
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    first = np.searchsorted(start, offs)
    return Words(data, start, end, np.repeat(np.arange(len(marked)), np.diff(first)), first)


_transducers: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """Ids of every text and, with ``decode``, the text they give back:
    id, n_pieces, pieces, decoded."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for b in batches:
            for few in slices(b, "text", 400_000):
                flat, first = t.encode(few.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat.astype(np.int32)))
                cols = [few.column("id"), pa.array(np.diff(first), pa.int64()), lists]
                if decode:
                    cols.append(pa.array([t.decode(flat[i:j]) for i, j in zip(first[:-1], first[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=["id", "n_pieces", "pieces", "decoded"][:len(cols)])
        t.forget()  # a worker lives on and serves other stages

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(lean(run), f"id {kind}, n_pieces long, pieces array<int>" + ", decoded string" * decode)
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """Text of every list of ids (null: empty): id, text."""
    rows = tokens.select(F.col(id_col).alias("id"), F.col(pieces_col).cast("array<int>").alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for b in batches:
            texts = [t.decode(np.array([i for i in ids or [] if i is not None], dtype=np.int64)) for ids in b.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
