"""Exact near-duplicate vectors by a metric range join over pivot cells.

Vectors are linked when their cosine, in double precision, reaches ``least``.
On the unit sphere that is a range join: the angle between linked vectors is
at most ``arccos(least)``, and angles obey the triangle inequality.

Plan.

* Equal vectors collapse into one class first, so copies cost one row.
* Pivots are picked far apart from a bounded sample.  Every class lives in the
  cell of its nearest pivot (its home) and is replicated, as a guest, to each
  other cell that a linked vector could live in: the triangle inequality on
  the angles to the two pivots, the cell's radius and the plane between the
  pivots say which.  So all links of a class are found in its home cell, and
  cells join independently: nothing is counted twice.
* A cell with too many homes is cut again by pivots of its own, as long as
  that saves comparisons.
* In a cell, classes within half the range of the pivot (its core) are all
  linked: their links are counted from one sum a cell, without comparing.  The
  rest is cut into blocks sorted by the angle to the pivot; blocks whose rings
  are further apart than the range are left out, and a task compares one block
  of homes with a few other blocks.  A hot cell is so spread over many tasks.
* A block names the links that join something new (a forest), and connected
  components run on those.

How much the pivots can prune follows the data: vectors without any structure
in many dimensions are all guests nearly everywhere, and the join then costs
all pairs, in blocks.  No pair within the range is ever left out.

Cases: a vector that is null, zero, or holds a null or non-finite component
links with nothing and is its own component; vectors of different lengths are
compared as if the shorter one went on with zeros; repeated rows are linked
vectors of their own; a row with a null id takes the smallest id of its
component, or null if there is none; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskview.llm.common import stored
from riskview.llm.components import components
from riskview.operators.joins import broadcast_if_small, fits

_SLACK = 1e-6  # of an angle: far above the rounding of arccos near 1
_NEAR = 1e-12  # a cosine this close to the threshold is computed again, correctly rounded sums
_BLOCK = pa.schema([("cell", pa.string()), ("home", pa.bool_()), ("core", pa.bool_()), ("lo", pa.float64()),
                    ("hi", pa.float64()), ("n", pa.int32()), ("ids", pa.binary()), ("w", pa.binary()), ("vecs", pa.binary())])
_ROW = pa.list_(pa.struct([("home", pa.bool_()), ("id", pa.int64()), ("w", pa.int64()), ("vec", pa.binary())]))
_FOUND = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


@dataclass(frozen=True)
class Range:
    """Parameters: least cosine, homes a cell should hold, most pivots a cell
    is cut by at once, rows of the sample they are picked from, levels, rows
    of a guest block, guest blocks a task takes."""

    least: float = 0.95
    cell: int = 8192
    pivots: int = 64
    sample: int = 1024
    levels: int = 6
    block: int = 4096
    chunk: int = 8

    @property
    def angle(self) -> float:
        return math.acos(self.least)

    @property
    def chord(self) -> float:
        return math.sqrt(2 - 2 * self.least)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, digest and components of every vector; both null if it takes no part."""
    for b in batches:
        out, digests = [], []
        for v in b.column("vec"):
            x = None
            if v.is_valid and not v.values.null_count:
                x = np.trim_zeros(v.values.to_numpy(zero_copy_only=False).astype("<f8"), "b") + 0.0  # no negative zeros
                if not len(x) or not np.isfinite(x).all():
                    x = None
            out.append(None if x is None else x.tobytes())
            digests.append(None if x is None else hashlib.blake2b(out[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(digests, pa.binary()), pa.array(out, pa.binary())],
                                         names=["id", "digest", "vec"])


def _matrix(raw: list[bytes]) -> np.ndarray:
    """Vectors as rows, the shorter ones padded with zeros."""
    rows = [np.frombuffer(r, "<f8") for r in raw]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for own, r in zip(out, rows):
        own[:len(r)] = r
    return out


def _units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by the largest component, so that no
    square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dim = min(a.shape[1], b.shape[1])
    return a[:, :dim], b[:, :dim]


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of unit rows; what is beyond the shorter length adds nothing."""
    a, b = _align(a, b)
    return a @ b.T


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_cosines(a, b), -1.0, 1.0))


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """Cosine with correctly rounded sums."""
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    n = min(len(x), len(y))
    return math.fsum(x[:n] * y[:n]) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _links(x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked rows; ``u`` and ``v`` are the units of ``x`` and ``y``."""
    cos = _cosines(u, v)
    i, j = np.nonzero(cos >= least - _NEAR)
    close = np.flatnonzero(cos[i, j] < least + _NEAR)
    keep = np.ones(len(i), dtype=bool)
    for k in close.tolist():
        keep[k] = exact_cosine(x[i[k]], y[j[k]]) >= least
    return i[keep], j[keep]


def _choose(how: Range) -> Callable[[pa.Table], pa.Table]:
    """Pivots of a cell from its sample: each the vector furthest from those
    before it, so a dense group gets one."""
    def run(group: pa.Table) -> pa.Table:
        x = _units(_matrix(group.column("vec").to_pylist()))
        k = min(how.pivots, max(1, -(-group.column("homes")[0].as_py() // how.cell)), len(x))
        start = int(np.argmax(x @ x.mean(axis=0)))
        picked, far = [start], _angles(x, x[start:start + 1])[:, 0]
        while len(picked) < k and far.max() > how.angle:
            picked.append(int(np.argmax(far)))
            far = np.minimum(far, _angles(x, x[picked[-1]:picked[-1] + 1])[:, 0])
        p = x[picked]
        return pa.table({"cell": group.column("cell").slice(0, 1), "k": pa.array([len(p)], pa.int32()),
                         "pivots": pa.array([p.tobytes()], pa.binary())})
    return run


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, one row a cell: what meets the cell's pivots."""
    for b in batches:
        order = pa.compute.sort_indices(b, sort_keys=[("cell", "ascending")])
        b = b.take(order)
        cells = b.column("cell").to_pylist()
        cuts = [i for i, c in enumerate(cells) if not i or c != cells[i - 1]] + [len(cells)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            for at in range(lo, hi, 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cells[lo]], pa.string()), pa.array([b.slice(at, min(4096, hi - at)).to_pylist()], _ROW)],
                    names=["cell", "rows"])


_ROWS = "cell string, rows array<struct<home:boolean,id:long,w:long,vec:binary>>"


def _nearest(how: Range) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each pivot of a cell, how far its own homes reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                homes = [x["vec"] for x in r["rows"] if x["home"]]
                if homes:
                    p = np.frombuffer(r["pivots"]).reshape(r["k"], -1)
                    far = _angles(_units(_matrix(homes)), p)
                    own = far.argmin(axis=1)
                    at = np.unique(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["cell"]] * len(at), pa.string()), pa.array(at, pa.int32()),
                         pa.array([far[own == s, s].max() for s in at], pa.float64())], names=["cell", "s", "reach"])
    return run


def _deal(how: Range) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every row to the cell of its nearest pivot and, as a guest, to the cells
    that a vector linked to it could live in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows = r["rows"]
                u = _units(_matrix([x["vec"] for x in rows]))
                p = np.frombuffer(r["pivots"]).reshape(r["k"], -1)
                reach = np.full(r["k"], -np.inf)
                for x in r["reaches"]:
                    reach[x["s"]] = x["reach"]
                cos = _cosines(u, p)
                far = np.arccos(np.clip(cos, -1.0, 1.0))
                own, each = far.argmin(axis=1), np.arange(len(u))
                near = far[each, own]
                apart = np.sqrt(np.maximum(2 - 2 * _cosines(p, p), 0))
                goes = far <= reach + how.angle + _SLACK
                goes &= far <= (near + 2 * how.angle + _SLACK)[:, None]
                goes &= cos[each, own][:, None] - cos <= how.chord * apart[own] + _SLACK
                home = np.zeros_like(goes)
                at = np.flatnonzero([x["home"] for x in rows])
                home[at, own[at]] = True
                i, s = np.nonzero(goes | home)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{r['cell']}.{k}" for k in s], pa.string()), pa.array([r["cell"]] * len(s), pa.string()),
                     pa.array(home[i, s], pa.bool_()),
                     pa.array([rows[k]["id"] for k in i], pa.int64()), pa.array([rows[k]["w"] for k in i], pa.int64()),
                     pa.array([rows[k]["vec"] for k in i], pa.binary()), pa.array(far[i, s], pa.float64())],
                    names=["cell", "parent", "home", "id", "w", "vec", "far"])
    return run


def _cut(rows: DataFrame, sizes: DataFrame, how: Range) -> DataFrame:
    """Deal the rows of every cell out to new cells: cell, home, id, w, vec, far."""
    # rows of a low hash only, some four samples a cell, so that no task meets all rows of a large cell
    low = F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(2.0 ** 63) * F.col("homes") < 4 * how.sample
    few = Window.partitionBy("cell").orderBy(F.xxhash64("id"), "id")
    sample = rows.where("home").join(broadcast_if_small(sizes.select("cell", "homes"), 4096), "cell").where(low)
    sample = (sample.withColumn("r", F.row_number().over(few)).where(F.col("r") <= how.sample)
              .select("cell", "vec", "homes"))
    pivots = stored(sample.groupBy("cell").applyInArrow(_choose(how), "cell string, k int, pivots binary"), "pivots")
    bundles = rows.select("cell", "home", "id", "w", "vec").mapInArrow(_bundles, _ROWS)
    reach = bundles.join(broadcast_if_small(pivots, 4096), "cell").mapInArrow(_nearest(how), "cell string, s int, reach double")
    reach = (reach.groupBy("cell", "s").agg(F.max("reach").alias("reach"))
             .groupBy("cell").agg(F.collect_list(F.struct("s", "reach")).alias("reaches")))  # one entry a pivot
    pivots = stored(pivots.join(reach, "cell"), "pivots")
    return stored(bundles.join(broadcast_if_small(pivots, 4096), "cell").mapInArrow(
        _deal(how), "cell string, parent string, home boolean, id long, w long, vec binary, far double"), "cells")


def _cells(classes: DataFrame, how: Range) -> DataFrame:
    """All classes in their cells: cell, home, id, w, vec, far."""
    def sizes(rows: DataFrame) -> DataFrame:
        sums = rows.groupBy("parent", "cell").agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
        return stored(sums.where("homes > 0"), "cell-sizes")

    def of(rows: DataFrame, cells: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(cells.select("cell")), "cell", "left_semi")

    at = classes.select(F.lit("").alias("cell"), F.lit("").alias("parent"), F.lit(True).alias("home"), "id", "w", "vec")
    at = _cut(at, sizes(at), how)
    large, done = sizes(at), []
    for _ in range(1, how.levels):
        many = stored(large.where(F.col("homes") > 2 * how.cell), "cells-many")
        if many.isEmpty():
            break
        whole = of(at, many)
        parts = _cut(whole, many, how)
        children = sizes(parts)
        # a cell stays cut only where that saves comparisons
        cost = (children.groupBy("parent").agg(F.sum(F.col("homes").cast("double") * F.col("all")).alias("cost"))
                .join(many.select(F.col("cell").alias("parent"), "homes", "all"), "parent"))
        cost = stored(cost.select("parent", (F.col("cost") < 0.8 * F.col("homes") * F.col("all")).alias("better")), "cell-costs")
        better = cost.where("better").select("parent")
        done += [of(at, large.where(F.col("homes") <= 2 * how.cell)),
                 of(whole, cost.where("NOT better").select(F.col("parent").alias("cell")))]
        at = parts.join(broadcast_if_small(better), "parent", "left_semi")
        large = children.join(broadcast_if_small(better), "parent", "left_semi")
    for more in done:
        at = at.unionByName(more)
    return at.drop("parent")


def _blocks(how: Range) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows as blocks of one cell, of homes or guests, core or not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def flush() -> pa.RecordBatch:
            far = [r["far"] for r in held]
            dim = max(len(r["vec"]) for r in held) // 8
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(
                    [*key, min(far), max(far), len(held), np.array([r["id"] for r in held], "<i8").tobytes(),
                     np.array([r["w"] for r in held], "<i8").tobytes(),
                     b"".join(r["vec"].ljust(8 * dim, b"\0") for r in held)], _BLOCK.types)], schema=_BLOCK)

        for b in batches:
            for r in b.to_pylist():
                now = (r["cell"], r["home"], r["core"])
                if held and (now != key or len(held) >= how.block):
                    yield flush()
                    held = []
                key = now
                held.append(r)
        if held:
            yield flush()
    return run


def _forest(i: np.ndarray, j: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) links that join what the pairs (a[i], b[j]) join."""
    names, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    left, right = at[:len(i)], at[len(i):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


def _compare(how: Range) -> Callable[[pa.Table], pa.Table]:
    """Links of one block of homes with a few blocks: the weight that every
    home is linked with, and a forest of the links."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = next(r for r in rows if r["own"])
        ids, x = np.frombuffer(own["ids"], "<i8"), np.frombuffer(own["vecs"]).reshape(own["n"], -1)
        u, total, out = _units(x), np.zeros(own["n"], np.int64), []
        for r in rows:
            if not r["meets"]:
                continue
            cids, w = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["w"], "<i8")
            y = np.frombuffer(r["vecs"]).reshape(r["n"], -1)
            v = _units(y)
            for lo in range(0, len(x), 1024):
                i, j = _links(x[lo:lo + 1024], y, u[lo:lo + 1024], v, how.least)
                i += lo
                other = ids[i] != cids[j]
                i, j = i[other], j[other]
                if len(i):
                    np.add.at(total, i, w[j])
                    out.append(_forest(i, j, ids, cids))
        hit = np.flatnonzero(total)
        node = np.concatenate([ids[hit], *[n for n, _ in out]])
        root = np.concatenate([ids[hit], *[r for _, r in out]])
        links = np.concatenate([total[hit], np.zeros(len(node) - len(hit), np.int64)])
        return pa.table([pa.array(node), pa.array(root), pa.array(links)], schema=_FOUND)
    return run


def range_links(classes: DataFrame, how: Range) -> DataFrame:
    """What the range join finds, as (node, root, links): ``links`` to be
    summed by node, and pairs of different nodes that are in one component.
    ``classes``: id, w (rows of the class), vec (little-endian doubles)."""
    cells = _cells(classes, how).withColumn("core", F.col("far") <= how.angle / 2 - _SLACK)
    order = ["cell", "home", "core", "far", "id"]
    core = (cells.where("core").groupBy("cell")
            .agg(F.sum("w").alias("weight"), F.min("id").alias("hub")))
    hubs = (cells.where("core").select("cell", "home", "id", "w").join(stored(core, "cores"), "cell")
            .select(F.col("id").alias("node"), F.col("hub").alias("root"),
                    F.when(F.col("home"), F.col("weight") - F.col("w")).otherwise(F.lit(0)).alias("links")))
    blocks = (cells.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(_blocks(how), "cell string, home boolean, core boolean, lo double, hi double, n int, "
                                        "ids binary, w binary, vecs binary"))
    blocks = stored(blocks.withColumn("b", F.monotonically_increasing_id()), "blocks")
    # which blocks meet: rings no further apart than the range, not both of the core
    short = blocks.select("cell", "home", "core", "lo", "hi", "b")
    mine = short.where("home").select("cell", F.col("core").alias("c"), F.col("lo").alias("l"), F.col("hi").alias("h"), F.col("b").alias("u"))
    pairs = mine.join(short, "cell").where(~(F.col("c") & F.col("core")))
    pairs = pairs.where((F.col("lo") - F.col("h") <= how.angle + _SLACK) & (F.col("l") - F.col("hi") <= how.angle + _SLACK))
    turn = Window.partitionBy("u").orderBy("b")
    pairs = stored(pairs.withColumn("t", F.floor((F.row_number().over(turn) - 1) / how.chunk).cast("int")).select("u", "t", "b"), "pairs")
    # a block of homes goes to each of its chunks once, whether or not it meets itself there
    sent = (pairs.select("u", "t", "b", F.lit(True).alias("meets"), (F.col("u") == F.col("b")).alias("own"))
            .union(pairs.select("u", "t", F.col("u").alias("b"), F.lit(False), F.lit(True)).distinct()))
    sent = sent.groupBy("u", "t", "b").agg(F.max("meets").alias("meets"), F.max("own").alias("own"))
    found = sent.join(blocks.select("b", "n", "ids", "w", "vecs"), "b").groupBy("u", "t").applyInArrow(
        _compare(how), "node long, root long, links long")
    return hubs.union(found)


def near_vectors(vectors: DataFrame, how: Range = Range(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Every vector with its direct links and its component: id, n_links
    (other vectors linked with it), component_id (smallest id reachable) and
    kept (id = component_id)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = stored(rows.mapInArrow(_clean, "id long, digest binary, vec binary"), "vectors")
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.count("*").alias("w"), F.min("id").alias("least"), F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    if fits(classes, 0):
        out = rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    else:
        found = stored(range_links(classes.select("id", "w", "vec"), how), "links")
        links = found.groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("links"))
        roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        known = (classes.select("id", "digest", "w", "least").join(roots.withColumnRenamed("node", "id"), "id", "left")
                 .withColumn("root", F.coalesce("root", "id")))
        known = stored(known.join(links, "id", "left"), "known")
        least = known.groupBy("root").agg(F.min("least").alias("component_id"))
        known = known.join(least, "root").select(
            "digest", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
        out = rows.select("id", "digest").join(known, "digest", "left").select(
            "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      (F.col("id") == F.col("component_id")).alias("kept"))
