"""URL rules as one bit-parallel wildcard automaton.

Every glob is packed into shared multiword Shift-And masks: one bit a pattern
position, with self loops for ``*``.  All patterns advance together over one
character of each URL, and all URLs of a batch advance together as numpy rows,
so a URL costs its length times the number of mask words, however many rules.

A URL is read in canonical form: ``.host`` + separator + ``path``, as UTF-8
bytes; the separator is a byte that UTF-8 never holds.  The leading dot makes a
rule's host match the host and every subdomain, and the separator keeps it out
of paths.  A default glob is matched as it is written against the whole of
``host/path``: its pattern begins with the dot, and the separator leaves its
states as they are.

Cases: a null URL or one without ``://`` has empty host and path; no rule fits
it and the default globs see an empty string.  Repeated rows are judged
alike.  An empty rule list is allowed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEP = 0xFF


@dataclass(frozen=True)
class Rule:
    """``pattern`` is ``host/path-prefix`` (``net/``, ``example.org/es/``)."""

    pattern: str
    verdict: str

    @property
    def glob(self) -> bytes:
        host, _, path = self.pattern.partition("/")
        escape = lambda s: s.replace("\\", "\\\\").replace("*", "\\*").replace("?", "\\?").encode()
        return b"*." + escape(host) + bytes([_SEP]) + b"/" + escape(path) + b"*"


class Automaton:
    """Globs (``*`` any run, ``?`` one byte, backslash escapes) as Shift-And
    masks.  Those of ``plain`` do not see the separator."""

    def __init__(self, globs: Sequence[bytes], plain: Sequence[bytes] = ()):
        aware, globs = len(globs), [*globs, *plain]
        steps: list[tuple[int, int, bool]] = []  # (pattern, byte or -1 for any, star follows)
        self.globs = tuple(globs)
        lead = np.zeros(len(globs), dtype=bool)
        for k, glob in enumerate(globs):
            raw, i, own = glob, 0, []
            while i < len(raw):
                c = raw[i]
                if c == ord("*"):
                    if own:
                        own[-1] = (k, own[-1][1], True)
                    else:
                        lead[k] = True
                else:
                    if c == ord("\\") and i + 1 < len(raw):
                        i, c = i + 1, raw[i + 1]
                        own.append((k, c, False))
                    else:
                        own.append((k, -1 if c == ord("?") else c, False))
                i += 1
            # position 0 of a pattern is its start state
            steps += [(k, -2, lead[k])] + own
        n = len(steps)
        self.words = max(1, (n + 63) // 64)
        self.step = np.zeros((256, self.words), dtype=np.uint64)  # byte -> positions it can enter
        self.stay = np.zeros((256, self.words), dtype=np.uint64)  # byte -> positions that it leaves as they are
        self.begin = np.zeros(self.words, dtype=np.uint64)
        last: dict[int, int] = {}
        for i, (k, c, star) in enumerate(steps):
            word, bit = divmod(i, 64)
            bit = np.uint64(1 << bit)
            if c == -2:
                self.begin[word] |= bit
            elif c == -1:
                self.step[:, word] |= bit
            else:
                self.step[c, word] |= bit
            if star:
                self.stay[:, word] |= bit
            if k >= aware:
                self.stay[_SEP, word] |= bit
                self.step[_SEP, word] &= ~bit
            last[k] = i
        self.accept = [(last[k] // 64, np.uint64(1 << (last[k] % 64))) for k in range(len(globs))]

    def run(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: text by glob, whole-text matches."""
        out = np.zeros((len(texts), len(self.globs)), dtype=bool)
        order = np.argsort([-len(t) for t in texts], kind="stable")
        for at in range(0, len(order), 1024):
            rows = order[at:at + 1024]
            width = len(texts[rows[0]])
            sizes = np.array([len(texts[r]) for r in rows])
            grid = np.zeros((len(rows), width), dtype=np.uint8)
            for j, r in enumerate(rows):
                grid[j, :sizes[j]] = np.frombuffer(texts[r], dtype=np.uint8)
            state = np.tile(self.begin, (len(rows), 1))
            live = np.searchsorted(-sizes, -np.arange(width), side="left")  # rows longer than i come first
            for i in range(width):
                s = state[:live[i]]
                moved = s << np.uint64(1)
                moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
                now = grid[:live[i], i]
                state[:live[i]] = (moved & self.step[now]) | (s & self.stay[now])
            for k, (word, bit) in enumerate(self.accept):
                out[rows, k] = (state[:, word] & bit) != 0
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    before_query = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(before_query, r"(?s)^[^/]*(.*)$", 1)


def judge(pages: DataFrame, rules: Sequence[Rule], block_globs: Sequence[str] = (),
          default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Verdict of every URL.

    The longest rule that fits decides; without one, ``block`` if a glob of
    ``block_globs`` matches the whole of ``host/path``, else ``default``.
    Returns id, host, path, rule (null if none fits), verdict.
    """
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    kind = parts.schema["id"].dataType.simpleString()
    ordered = sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))
    machine = Automaton([r.glob for r in ordered], [b"." + g.encode() for g in block_globs])
    names = np.array([r.pattern for r in ordered] + [None], dtype=object)
    verdicts = np.array([r.verdict for r in ordered] + [None], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths = b.column("host").to_pylist(), b.column("path").to_pylist()
            fits = machine.run([b".%s%c%s" % (h.encode(), _SEP, p.encode()) for h, p in zip(hosts, paths)])
            by_rule, by_glob = fits[:, :len(ordered)], fits[:, len(ordered):].any(axis=1)
            best = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1) if len(ordered) else 0, len(ordered))
            verdict = np.where(best < len(ordered), verdicts[best], np.where(by_glob, "block", default))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("host"), b.column("path"),
                 pa.array(names[best], pa.string()), pa.array(verdict, pa.string())],
                names=["id", "host", "path", "rule", "verdict"])

    out = parts.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)

