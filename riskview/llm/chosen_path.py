"""MinHash near-duplicates by chosen-path set similarity join.

Every document's set of word shingles gets a signature of ``tokens`` minwise
values.  A tree node holds documents that agree on the tokens chosen on the
path to it.  A node of at most ``small`` documents is compared exhaustively; a
larger one branches by ``branch`` further tokens that a hash of its path
chooses, unless its members are alike on average, when branching cannot part
them and the node is compared as it is, block against block.  ``trees``
independent trees (their roots use different tokens) repeat this: a pair of
similarity ``s`` is missed with probability ``q ** trees``, where
``q = (1 - s (1 - q)) ** branch`` - 1e-6 for s = 0.85, 1e-5 for s = 0.8 - to
which the look at signatures below adds at most 1e-6 a node.

Plan.

* Documents with equal sets collapse into one class first, so a group of
  copies costs one row.
* Trees hold (node, class) rows; nodes met by one class go after a partial
  count.  Signatures are joined to the rest, and a node names the pairs whose
  signatures could reach the threshold (a pair at it is left out with a
  probability below 1e-6), reduced to links that join the same classes.  The components of these links
  are the clusters outside which no link can lie.
* Full sets are recomputed for the classes of clusters alone and travel once,
  to their cluster, where every link is confirmed on them: the intersections of
  two blocks of sets are one product of 0/1 matrices over shared shingles.
* A cluster of at most ``small`` classes is one group.  In a larger one the
  most central members meet all others first, which joins most groups of near
  copies in one pass; what stays outside the largest component then meets
  every member, block against block.  A task holds two blocks at most, and a
  pair is left out only if links found before have joined it.

Cases: null or blank text has an empty set and is its own component; fewer
words than a shingle give the whole sequence as one shingle; repeated rows and
ids share a component; a document with a null id takes the smallest id of its
component, or null if there is none; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskview.llm.common import lean, slices, stored
from riskview.llm.components import components
from riskview.llm.words import Words, mix, words_of
from riskview.operators.joins import broadcast_if_small

_SET = 0xA24BAED4963EE407  # fixed value: odd multiplier of the shingle hash
_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text; the whole sequence
    is one shingle of a text with fewer words."""
    codes, out = words.codes(), []
    n = len(codes)
    acc = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        acc += codes[k:n - width + 1 + k] * np.uint64(pow(_SET, 2 * k + 1, 2 ** 64)) if len(acc) else acc
    acc = mix(acc)
    for lo, hi in zip(words.first[:-1], words.first[1:]):
        if hi - lo >= width:
            out.append(np.unique(acc[lo:hi - width + 1]))
        elif hi > lo:
            few = sum(int(c) * pow(_SET, 2 * k + 1, 2 ** 64) for k, c in enumerate(codes[lo:hi])) + int(hi - lo)
            out.append(mix(np.array([few % 2 ** 64], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _signatures(sets: list[np.ndarray], tokens: int) -> np.ndarray:
    """Minwise values: the least of ``tokens`` re-hashes over each set."""
    out = np.zeros((len(sets), tokens), dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        heads = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        odd = np.random.default_rng(5).integers(1, 2 ** 63, tokens, dtype=np.uint64) | np.uint64(1)
        for t in range(tokens):
            out[full, t] = np.minimum.reduceat((flat * odd[t]) >> np.uint64(32), heads).astype(np.uint32)
    return out


def _class_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sign(width: int, lower: bool, tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text"):
                sets = shingle_sets(words_of(few.column("text"), lower), width)
                sig = _signatures(sets, tokens)
                yield pa.RecordBatch.from_arrays(
                    [few.column("id"), few.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_class_of(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["id", "key", "n", "digest", "sig"])
    return run


def _branch(path: int, level: int, sig: np.ndarray, branch: int, trees: int) -> list[tuple[int, int]]:
    """(tree, node) of every child: the root opens ``branch`` children in each
    tree by tokens of its own, a node opens them by tokens its path chooses."""
    tokens = len(sig)
    if level == 0:
        picks = [(tree, (tree * branch + k) % tokens) for tree in range(trees) for k in range(branch)]
    else:
        r = np.random.default_rng([level, path % 2 ** 63])
        picks = [(0, int(t)) for t in r.choice(tokens, size=branch, replace=False)]
    return [(tree, _node(path, tree, t, int(sig[t]))) for tree, t in picks]


def _node(path: int, tree: int, token: int, value: int) -> int:
    raw = path.to_bytes(8, "little", signed=True) + bytes((tree, token)) + value.to_bytes(4, "little")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _grow(level: int, branch: int, trees: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs = [np.frombuffer(s.as_buffer(), np.uint32) for s in b.column("sig")]
            rows, nodes = [], []
            for i, (path, sig) in enumerate(zip(b.column("node").to_pylist(), sigs)):
                for _, node in _branch(path, level, sig, branch, trees):
                    rows.append(i)
                    nodes.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), b.column("class").take(pa.array(rows, pa.int32()))],
                                             names=["node", "class"])
    return run


def _agreement(sig: np.ndarray) -> np.ndarray:
    """Share of tokens on which each two signatures agree."""
    agree = np.zeros((len(sig), len(sig)), dtype=np.int16)
    for t in range(sig.shape[1]):
        agree += sig[:, t, None] == sig[None, :, t]
    return agree / sig.shape[1]


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    return np.vstack([np.frombuffer(s.as_buffer(), np.uint32) for s in column.combine_chunks()])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Of links between ``n`` members, those that join something new, and
    each member's root."""
    up = list(range(n))

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    kept = []
    for i, j in zip(a.tolist(), b.tolist()):
        p, q = root(i), root(j)
        if p != q:
            up[max(p, q)] = min(p, q)
            kept.append((i, j))
    return kept, [root(k) for k in range(n)]


def _promising(floor: float, threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Members of a small node whose sizes (exactly) and signatures (with
    slack) allow similarity, linked to the least of those they join."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("class")  # trees that meet the same members name the same links
        n = group.column("n").to_numpy()
        pairs = _agreement(_stack(group.column("sig"))) >= floor
        pairs &= np.minimum(n[:, None], n) >= threshold * np.maximum(n[:, None], n)
        _, roots = _forest(*np.nonzero(np.triu(pairs, 1)), len(n))
        linked = [(r, k) for k, r in enumerate(roots) if r != k]
        name = group.column("class").combine_chunks()
        return pa.table([name.take(pa.array([k[s] for k in linked], pa.int32())) for s in (0, 1)], schema=_LINKS)
    return run


def _central(group: pa.Table) -> pa.Table:
    """The two most central members of a block of a large node, with the share
    of tokens on which they, and all members, agree with the block."""
    near = _agreement(_stack(group.column("sig"))).mean(axis=1)
    top = np.argsort(-near, kind="stable")[:2]
    return pa.table({"node": group.column("node").take(pa.array(top)), "class": group.column("class").take(pa.array(top)),
                     "near": pa.array(near[top]), "alike": pa.array([float(near.mean())] * len(top))})


def _resets(width: int, lower: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for few in slices(b, "text"):
                sets = shingle_sets(words_of(few.column("text"), lower), width)
                both = pa.RecordBatch.from_arrays([few.column("class"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                  names=["class", "set"])
                # a row that only shares the representative's 64-bit key is not of its class
                yield both.filter(pa.array([c == _class_of(s) for c, s in zip(few.column("digest").to_pylist(), sets)]))
    return run


def _sets(t: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("set").combine_chunks()]


def _intersections(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``."""
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    _, at = np.unique(np.concatenate(x + y), return_inverse=True)
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in x + y])
    left = row < len(x)
    width = int(at.max()) + 1
    met = (np.bincount(at[left], minlength=width) > 0) & (np.bincount(at[~left], minlength=width) > 0)
    rank = np.cumsum(met) - 1
    row, at, left = row[met[at]], rank[at[met[at]]], left[met[at]]
    for lo in range(0, int(met.sum()), 8192):
        own = (at >= lo) & (at < lo + 8192)
        a = np.zeros((len(x), 8192), dtype=np.float32)
        b = np.zeros((len(y), 8192), dtype=np.float32)
        a[row[own & left], at[own & left] - lo] = 1
        b[row[own & ~left] - len(x), at[own & ~left] - lo] = 1
        out += a @ b.T
    return out


def _linked(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of ``x`` and ``y`` are similar enough."""
    both = _intersections(x, y).astype(np.int64)
    union = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y]) - both
    return 100 * both >= percent * union


def _settle(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Component of every member of a small cluster."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("class")
        sets = _sets(group)
        _, roots = _forest(*np.nonzero(np.triu(_linked(sets, sets, percent), 1)), len(sets))
        name = group.column("class").combine_chunks()
        return pa.table([name, name.take(pa.array(roots, pa.int32()))], names=["class", "root"])
    return run


def _confirm(percent: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Links between the members of two blocks of different components:
    enough of them to join whatever they join."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _LINKS.empty_table()
        names = sorted(set(left.column("root").to_pylist()) | set(right.column("root").to_pylist()))
        number = {r: i for i, r in enumerate(names)}
        a = np.array([number[r] for r in left.column("root").to_pylist()])
        b = np.array([number[r] for r in right.column("root").to_pylist()])
        i, j = np.nonzero(_linked(_sets(left), _sets(right), percent) & (a[:, None] != b))
        at = {}
        for u, v, p, q in zip(i.tolist(), j.tolist(), a[i].tolist(), b[j].tolist()):
            at.setdefault((p, q), (u, v))
        kept, _ = _forest(np.array([p for p, _ in at], dtype=int), np.array([q for _, q in at], dtype=int), len(names))
        found = [at[k] for k in kept]
        return pa.table([left.column("class").combine_chunks().take(pa.array([u for u, _ in found], pa.int32())),
                         right.column("class").combine_chunks().take(pa.array([v for _, v in found], pa.int32()))],
                        schema=_LINKS)
    return run


@dataclass(frozen=True)
class Join:
    """Parameters of the join: words a shingle, least similarity in per cent,
    A-Z lower-cased or not, signature length, trees, branches and levels, size
    up to which a node is compared at once, central members of a large node."""

    width: int = 5
    percent: int = 80
    lower: bool = True
    tokens: int = 32
    trees: int = 4
    branch: int = 2
    levels: int = 3
    small: int = 512
    pivots: int = 8

    @property
    def floor(self) -> float:
        """Least share of agreeing tokens that a node looks at: the largest
        count that a pair at the threshold stays below with a probability of
        at most 1e-6, below the trees' own share of missed pairs."""
        p, below = self.percent / 100, 0.0
        for k in range(self.tokens + 1):
            below += comb(self.tokens, k) * p ** k * (1 - p) ** (self.tokens - k)
            if below > 1e-6:
                return k / self.tokens
        return 1.0


def _block(size: Column, small: int) -> Column:
    return F.pmod(F.xxhash64("class"), F.ceil(size / small)).cast("int")


def _candidates(classes: DataFrame, how: Join) -> DataFrame:
    """Links (a, b) whose components hold every pair that may be similar, to be read once."""
    small, links, at = [], [], classes.select(F.lit(0).cast("long").alias("node"), "class", "sig")
    for level in range(how.levels):
        rows = stored(at.mapInArrow(lean(_grow(level, how.branch, how.trees)), "node long, class binary"), "tree")
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        met = stored(rows.join(sizes, "node").join(classes, "class").select("node", "class", "size", "n", "sig"), "tree-nodes")
        small.append(met.where(F.col("size") <= how.small).select(F.lit(level).alias("level"), "node", "class", "n", "sig"))
        many = met.where(F.col("size") > how.small)
        left = many.count()
        if not left:
            break
        if level + 1 == how.levels:
            hubs = stored(many.groupBy("node").agg(F.min("class").alias("hub")), "tree-hubs", left // how.small)
            links.append(many.select("node", "class").join(hubs, "node").select(F.col("hub").alias("a"), F.col("class").alias("b")))
            break
        # nodes whose members are alike are clusters as they are, as any at the last level are
        blocks = many.select("node", "class", "sig", _block(F.col("size"), how.small).alias("block"))
        kinds = stored(blocks.groupBy("node", "block").applyInArrow(
            _central, "node long, class binary, near double, alike double").groupBy("node").agg(
            (F.avg("alike") >= 0.4).alias("dense"), F.min("class").alias("hub")), "tree-kinds", left // how.small)
        many = stored(many.select("node", "class", "sig").join(kinds, "node"), "tree-large")
        links.append(many.where("dense").select(F.col("hub").alias("a"), F.col("class").alias("b")))
        at = many.where("NOT dense").select("node", "class", "sig")
    met = small[0]
    for more in small[1:]:
        met = met.union(more)
    # one pass over the small nodes of all levels
    out = met.groupBy("level", "node").applyInArrow(_promising(how.floor, how.percent / 100), "a binary, b binary")
    for more in links:
        out = out.union(more)
    return out


def _open_clusters(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the clusters that hold more than one component so far:
    cluster, class, size, block, root, main (the largest component)."""
    rows = members.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rows = stored(rows, "members", members.count())
    sizes = (rows.groupBy("cluster", "root").agg(F.count("*").alias("own"))
             .groupBy("cluster").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("own", "root")).alias("main")))
    return stored(rows.join(stored(sizes.where("roots > 1").drop("roots"), "sizes", rows.count()), "cluster"), "open")


def _settle_large(members: DataFrame, classes: DataFrame, how: Join) -> DataFrame:
    """Components in clusters too large for one group, as (class, root).
    ``members``: cluster, class, size, block, set."""
    keys = ["cluster", "u", "block"]
    sets, members = members.select("class", "set"), members.drop("set")

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        columns = [*keys, "class", "root"]
        left, right = (d.select(*columns).join(sets, "class").select(*columns, "set").toDF(*columns, "set")
                       for d in (left, right))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_confirm(how.percent), "a binary, b binary")

    def in_every_block(rows: DataFrame) -> DataFrame:
        return rows.withColumn("block", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("size") / how.small) - 1).cast("int"))))

    by_near = Window.partitionBy("node").orderBy(F.desc("near"), "class")
    central = (members.join(classes.select("class", "sig"), "class")
               .select(F.xxhash64("cluster").alias("node"), "block", "class", "sig").groupBy("node", "block")
               .applyInArrow(_central, "node long, class binary, near double, alike double")
               .withColumn("rank", F.row_number().over(by_near)).where(F.col("rank") <= how.pivots).select("class"))
    pivots = in_every_block(members.join(stored(central, "pivots"), "class").withColumn("root", F.col("class")))
    roots = components(meet(pivots.withColumn("u", F.lit(0)),
                            members.withColumn("root", F.col("class")).withColumn("u", F.lit(0))))
    rows = _open_clusters(members, roots)
    outside = stored(in_every_block(rows.where("root <> main").withColumnRenamed("block", "u")), "outside")
    wanted = outside.select(*keys).distinct()
    found = roots.toDF("a", "b").union(meet(outside, rows.join(wanted, ["cluster", "block"])))
    return components(found).withColumnRenamed("node", "class")


def link_classes(classes: DataFrame, rows: DataFrame, how: Join) -> DataFrame:
    """Component of every linked class, as (class, root), to be read once.

    ``classes``: class, n, sig and the key of one row that has it, one row a
    class, in the order that roots follow; ``rows``: key, text."""
    clusters = components(_candidates(classes.select("class", "n", "sig"), how)).toDF("class", "cluster")
    sizes = stored(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "cluster-sizes", clusters.count())
    clusters = stored(clusters.join(sizes, "cluster").withColumn("block", _block(F.col("size"), how.small)), "clusters")
    active = stored(clusters.select("class").join(classes.select("class", "key", "digest"), "class"), "active")
    sets = (rows.select("key", "text").join(broadcast_if_small(active), "key").select("class", "digest", "text")
            .mapInArrow(lean(_resets(how.width, how.lower)), "class binary, set binary"))
    sets = sets.groupBy("class").agg(F.first("set").alias("set"))  # a repeated row comes more than once
    members = stored(sets.join(clusters, "class"), "cluster-sets")
    small = members.where(F.col("size") <= how.small).select("cluster", "class", "set")
    out = small.groupBy("cluster").applyInArrow(_settle(how.percent), "class binary, root binary")
    large = members.where(F.col("size") > how.small)
    if not large.isEmpty():
        large = stored(large, "large-clusters")
        out = out.union(_settle_large(large, classes, how).select("class", "root"))
    return out


_SIGN = -(1 << 63)


def _name(least: Column, digest: Column) -> Column:
    """A class's name: sorts by its smallest id, classes without one last."""
    return F.concat(F.unhex(F.coalesce(F.lpad(F.hex(least.bitwiseXOR(F.lit(_SIGN))), 16, "0"), F.lit("F" * 16))), digest)


def _least(name: Column) -> Column:
    """The smallest id that a class's name holds; null if it has none."""
    head = F.hex(F.substring(name, 1, 8))
    return F.when(head != "F" * 16, F.conv(head, 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN)))


def _components(docs: DataFrame, how: Join, id_col: str, text_col: str) -> DataFrame:
    """id, key (of id and text), n, root and component_id of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    signed = stored(rows.mapInArrow(lean(_sign(how.width, how.lower, how.tokens)),
                                    "id long, key long, n long, digest binary, sig binary"), "signatures")
    # one row a class: of equal sets, sizes and signatures are equal too
    classes = stored(signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("id").alias("least"), F.min("key").alias("key"))
        .select("digest", "n", "sig", "key", _name(F.col("least"), F.col("digest")).alias("class")), "classes")
    roots = link_classes(classes, rows, how)
    # a class's name holds its smallest id, so a root's name holds its component's
    root = classes.select("digest", "class").join(roots, "class", "left").select(
        "digest", F.coalesce("root", "class").alias("root"))
    out = signed.select("id", "key", "n", "digest").join(root, "digest", "left")
    alone = F.col("digest").isNull()
    return out.select("id", "key", "n", "root", F.when(alone, F.col("id")).otherwise(_least(F.col("root"))).alias("component_id"))


def near_duplicates(docs: DataFrame, how: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate component of every document: id, n_shingles,
    component_id (smallest id reachable) and kept (id = component_id)."""
    out = _components(docs, how, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      (F.col("id") == F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, how: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, but of each component only the one with the
    smallest id (of equal ids, one).  Documents without words all stay."""
    found = stored(_components(docs, how, id_col, text_col).where("root IS NOT NULL"), "components")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("first"))
    first = stored(first.select("root", F.col("first.key").alias("first")), "first")
    gone = found.join(first, "root").where(F.col("key") != F.col("first")).select("id", "key").distinct()
    gone = broadcast_if_small(stored(gone, "gone"))
    again = stored(found.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "again")
    key = F.xxhash64(docs[id_col].cast("long"), docs[text_col])
    # a row goes only if its id agrees too: a 64-bit key alone may meet another text's
    kept = docs.join(gone, (key == gone["key"]) & docs[id_col].cast("long").eqNullSafe(gone["id"]), "left_anti")
    if again.isEmpty():
        return kept
    again = broadcast_if_small(again)
    key = F.xxhash64(kept[id_col].cast("long"), kept[text_col])
    repeated = (kept.join(again, key == again["key"], "left_semi")
                .groupBy(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("key"))
                .agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*"))
    return kept.join(again, key == again["key"], "left_anti").unionByName(repeated)
