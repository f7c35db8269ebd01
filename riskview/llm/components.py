"""Connected components of a link table by hooking, jumps and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskview.llm.common import stored


def _tops(labels: DataFrame, rows: int) -> DataFrame:
    """``labels(node, root)``, every root being a node, with roots followed to
    the end: each pass takes the root of the root, which halves the way left."""
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = stored(labels.join(up, "root").select("node", F.col("root").alias("old"), F.col("far").alias("root")),
                      "labels", rows)
        labels = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return labels


def _open(links: DataFrame) -> DataFrame:
    """Links between different nodes, each from the smaller one."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``links(a, b)``.

    Each round a node takes the least among itself and its neighbours (partial
    minimums, so a hub ships one row a task) and follows it to the end.  Links
    are then drawn between the ends: links inside a group go and equal ones
    become one, so the next round meets only what is still to be joined, not
    all links again.  Rounds end when no link is left.  Only linked nodes are
    returned, as ``(node, root)``.  ``links`` is read once.
    """
    rounds, links = [], stored(_open(links), "links")
    rows = most = links.count()
    while rows or not rounds:
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("near")).union(links.select("b", "a"))
        least = ends.groupBy("node").agg(F.least("node", F.min("near")).alias("root"))
        rounds.append(_tops(stored(least, "labels", 2 * rows), 2 * rows))
        links = links.distinct()
        for end in ("a", "b"):
            links = links.join(rounds[-1].withColumnRenamed("node", end), end).drop(end).withColumnRenamed("root", end)
        links = stored(_open(links), "links", rows)
        rows = links.count()
    labels = rounds.pop()
    if not rounds:
        return labels
    while rounds:
        far = labels.toDF("root", "far")
        labels = rounds.pop().join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root"))
    return stored(labels, "labels", 2 * most)
