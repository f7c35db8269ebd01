"""Exact top-k inner products by three phases with a uniform threshold.

The components of every vector are cut into ``slices`` lists; a query's score
is the sum of its partial scores over the lists.

1. Gather: every task returns, for each query and list, the least partial
   score and the scores of its ``k`` best entries of that list.  The k-th best
   exact score that any task has seen is a safe cutoff ``tau``: k vectors reach it.
2. Cutoff: an entry can reach ``tau`` only if in some list its partial score
   is at least that list's least plus ``(tau - sum of leasts) / slices``.  The
   cutoffs travel with the query blocks, and every list yields those entries.
3. Resolve: the scores of the entries found are completed exactly, and each
   task keeps its k best of them for the final ranking.

Plan.  Candidates are packed into blocks where they lie, queries into blocks
of bounded size; each candidate block meets each query block by an equi-join
on the block number (the query side is broadcast only when its size is
proven).  Scores are integers; the matrix product in doubles is used only when
it is provably exact, else Python integers are.

Cases: vectors that are null or hold a null or non-finite component take no
part, nor do null ids; of different lengths, the shared components count; a
repeated row is a candidate each time and, as a query, answered once; a score
outside 64 bits is returned as null and ranked as a double; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskview.llm.common import stored

_BROADCAST_BYTES = 64 << 20


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part and their components as floor(256 x), zero-padded."""
    n = len(vectors)
    lists = vectors.cast(pa.list_(pa.float64()))
    sizes = np.array([0 if s is None else s for s in pa.compute.list_value_length(lists).to_pylist()], dtype=np.int64)
    flat = lists.flatten()
    bad = np.asarray(flat.is_null()) if flat.null_count else np.zeros(len(flat), dtype=bool)
    values = np.floor(256.0 * flat.fill_null(0.0).to_numpy(zero_copy_only=False))
    bad |= ~np.isfinite(values)
    row = np.repeat(np.arange(n), sizes)
    good = ~np.asarray(vectors.is_null())
    good[row[bad]] = False
    wide = np.zeros((n, int(sizes.max(initial=0))))
    wide[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return good, wide[good]


def _packed(part: int, ids: pa.Array, vecs: pa.Array) -> list[pa.RecordBatch]:
    good, wide = _matrix(vecs)
    ids = ids.to_numpy(zero_copy_only=False)[good]
    return [pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([wide.shape[1]], pa.int32()),
         pa.array([ids.astype("<i8").tobytes()], pa.binary()),
         pa.array([np.ascontiguousarray(wide).tobytes()], pa.binary())],
        names=["part", "dim", "ids", "vecs"])] if len(ids) else []


def _pack(rows: int | None):
    """Blocks of at most ``rows`` vectors, or one block a partition: ids and a
    matrix of doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        if rows is None:
            batches = [t for t in [pa.Table.from_batches(b) for b in [list(batches)] if b]]
        for b in batches:
            for at in range(0, b.num_rows, rows or b.num_rows):
                some = b.slice(at, rows)
                ids, vecs = some.column("id"), some.column("vec")
                if isinstance(ids, pa.ChunkedArray):
                    ids, vecs = ids.combine_chunks(), vecs.combine_chunks()
                yield from _packed(part, ids, vecs)
    return run


def _products(q: np.ndarray, c: np.ndarray, slices: int) -> list[np.ndarray]:
    """Partial scores of queries by candidates for each list of components."""
    dim = min(q.shape[1], c.shape[1])
    if dim and np.abs(q).max() * np.abs(c).max() * dim >= 2.0 ** 53:
        whole = lambda a: np.array([[int(x) for x in r] for r in a.tolist()], dtype=object).reshape(a.shape)
        q, c = whole(q), whole(c)
    cuts = np.linspace(0, dim, slices + 1).astype(int)
    return [q[:, a:b] @ c[:, a:b].T if b > a else np.zeros((len(q), len(c))) for a, b in zip(cuts[:-1], cuts[1:])]


def _read(r: dict, key: str) -> np.ndarray:
    n, dim = len(r[f"{key}ids"]) // 8, r[f"{key}dim"]
    return np.frombuffer(r[f"{key}vecs"]).reshape(n, dim)


class _Block:
    """What a task knows of one block of queries: per query the k best
    (score, id) so far, ties to smaller ids, and the least score of each list."""

    def __init__(self, qids: np.ndarray, k: int, slices: int):
        self.qids, self.k = qids, k
        self.best: list[list[tuple]] = [[] for _ in qids]
        self.least: list[list] = [[None] * slices for _ in qids]

    def add(self, i: int, scores: list, ids: list) -> None:
        own = self.best[i]
        own.extend((-s, d) for s, d in zip(scores, ids))
        own.sort()
        del own[self.k:]

    def lower(self, parts: list[np.ndarray]) -> None:
        for j, p in enumerate(parts):
            for own, low in zip(self.least, p.min(axis=1).tolist()):
                own[j] = low if own[j] is None else min(own[j], low)


def _blocks(k: int, slices: int, step, emit):
    """Run ``step`` on every pair of a query and a candidate block, keeping a
    few query blocks open, and ``emit`` each when it leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Block] = {}
        for b in batches:
            for r in b.to_pylist():
                if r["q"] not in held:
                    if len(held) >= 8:
                        yield from [emit(n, held.pop(n)) for n in list(held)]
                    held[r["q"]] = _Block(np.frombuffer(r["q_ids"], "<i8"), k, slices)
                own, cids = held[r["q"]], np.frombuffer(r["ids"], "<i8")
                step(own, cids, _products(_read(r, "q_"), _read(r, ""), slices), r)
        for n, own in held.items():
            yield emit(n, own)
    return run


def _gather(k: int):
    def step(own: _Block, cids: np.ndarray, parts: list[np.ndarray], r: dict) -> None:
        total, n = sum(parts), min(k + 1, len(cids))  # one more: the query itself may be listed
        own.lower(parts)
        tops = [np.argpartition(-p, n - 1, axis=1)[:, :n] if p.dtype != object else np.argsort(-p, axis=1)[:, :n]
                for p in parts]
        for i, qid in enumerate(own.qids):
            listed = np.unique(np.concatenate([t[i] for t in tops]))
            listed = listed[cids[listed] != qid]
            own.add(i, total[i, listed].tolist(), cids[listed].tolist())
    return step


def _gathered(q: int, own: _Block) -> pa.RecordBatch:
    rows = [{"q": q, "i": i, "tau": _down(-b[-1][0]) if len(b) == own.k else None, "least": [_down(x) for x in low]}
            for i, (b, low) in enumerate(zip(own.best, own.least))]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(
        [("q", pa.int32()), ("i", pa.int32()), ("tau", pa.float64()), ("least", pa.list_(pa.float64()))]))


def _down(x) -> float:
    """``x`` as a double that is not above it."""
    return float(x) if abs(x) < 2 ** 53 else float(np.nextafter(float(x), -np.inf))


def _resolve(slices: int):
    def step(own: _Block, cids: np.ndarray, parts: list[np.ndarray], r: dict) -> None:
        total = sum(parts)
        for i, (qid, tau, least) in enumerate(zip(own.qids, r["taus"], r["leasts"])):
            if tau is None:
                hit = np.arange(len(cids))
            else:  # slices * (partial - least) >= tau - sum of leasts, in some list
                gap = tau - sum(least)
                hit = np.flatnonzero(np.any([slices * (p[i] - low) >= gap for p, low in zip(parts, least)], axis=0))
                hit = hit[total[i, hit] >= tau]
            hit = hit[cids[hit] != qid]
            if len(hit) > own.k and total.dtype != object:  # ties at the last place stay
                last = -np.partition(-total[i, hit], own.k - 1)[own.k - 1]
                hit = hit[total[i, hit] >= last]
            own.add(i, total[i, hit].tolist(), cids[hit].tolist())
    return step


def _resolved(q: int, own: _Block) -> pa.RecordBatch:
    rows = [(q, i, int(qid), int(d), int(-s)) for i, (qid, b) in enumerate(zip(own.qids, own.best)) for s, d in b]
    col = list(zip(*rows)) or [()] * 5
    fits = [s if -2 ** 63 <= s < 2 ** 63 else None for s in col[4]]
    return pa.RecordBatch.from_arrays(
        [pa.array(col[0], pa.int32()), pa.array(col[1], pa.int32()), pa.array(col[2], pa.int64()),
         pa.array(col[3], pa.int64()), pa.array(fits, pa.int64()), pa.array([float(s) for s in col[4]], pa.float64())],
        names=["q", "i", "query_id", "vec_id", "score", "near"])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding",
          slices: int = 2, query_block: int = 512, candidate_block: int = 4096, broadcast_bytes: int = _BROADCAST_BYTES,
          salt_blocks: int = 64) -> DataFrame:
    """The ``k`` best other vectors of every query (rows whose id is divisible
    by ``every``): query_id, rank, vec_id, score.

    Query blocks are broadcast up to ``broadcast_bytes``.  Beyond, they are
    joined by block and salt, each key with about ``salt_blocks`` blocks of
    candidates, so no task meets all candidates."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where("id IS NOT NULL")
    packed = "part int, dim int, ids binary, vecs binary"
    asked = rows.where(F.col("id") % every == 0).distinct()
    blocks = max(1, -(-asked.count() // query_block))
    queries = asked.repartition(blocks).mapInArrow(_pack(None), packed)
    queries = stored(queries.select(F.col("part").alias("q"), *[F.col(c).alias(f"q_{c}") for c in ("dim", "ids", "vecs")]),
                     "topk-queries")
    size = queries.agg(F.sum(F.length("q_vecs") + F.length("q_ids"))).first()[0] or 0
    candidates = stored(rows.mapInArrow(_pack(candidate_block), packed), "topk-vectors")
    pairs = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(side: DataFrame) -> DataFrame:
        if size <= broadcast_bytes:
            return pairs.join(F.broadcast(side), "q")
        salts = max(1, -(-candidates.count() // salt_blocks))
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int"))
        spread = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return salted.join(spread, ["q", "salt"]).drop("salt")

    lists = meet(queries).mapInArrow(_blocks(k, slices, _gather(k), _gathered),
                                     "q int, i int, tau double, least array<double>")
    cut = lists.groupBy("q", "i").agg(F.max("tau").alias("tau"),
                                      F.array(*[F.min(F.col("least")[j]) for j in range(slices)]).alias("least"))
    # one row a query block: its queries in order, so bounded by query_block
    cut = cut.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("i", "tau", "least"))).alias("c"))
    cut = stored(cut.select("q", F.col("c.tau").alias("taus"), F.col("c.least").alias("leasts")), "topk-cutoffs")
    found = meet(queries.join(cut, "q")).mapInArrow(
        _blocks(k, slices, _resolve(slices), _resolved),
        "q int, i int, query_id long, vec_id long, score long, near double")
    rank = Window.partitionBy("q", "i").orderBy(F.desc("near"), F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
