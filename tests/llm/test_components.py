import random

from riskview.llm import components as module
from riskview.llm.components import components


def brute(links):
    least = {v: v for pair in links for v in pair}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(least[a], least[b])
            moved |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def tangle(seed):
    """A group met by many links, as near copies are, a chain and pairs."""
    rng = random.Random(seed)
    group = [(rng.randrange(400), rng.randrange(400)) for _ in range(3000)]
    names = list(range(1000, 1064))
    rng.shuffle(names)
    return [(a, b) for a, b in group if a != b] + list(zip(names, names[1:])) + [(2000 + 2 * i, 2001 + 2 * i) for i in range(20)]


def test_against_brute_force(spark):
    links = tangle(1)
    odd = links + links[:50] + [(b, a) for a, b in links[:50]] + [(5000, 5000), (None, 3), (3, None), (None, None)]
    assert dict(components(spark.createDataFrame(odd, "a long, b long")).collect()) == brute(links)
    names = [(b"%06d" % a, b"%06d" % b) for a, b in links]
    got = {bytes(n): bytes(r) for n, r in components(spark.createDataFrame(names, "a binary, b binary")).collect()}
    assert got == brute(names)


def test_rounds_meet_only_links_still_open(spark, monkeypatch):
    links = tangle(2)
    frame = spark.createDataFrame(links, "a long, b long")
    made, join = [], type(frame).join

    def counted(self, *args, **how):
        out = join(self, *args, **how)
        if {"a", "b"} & {*self.columns}:  # joins of links, not of nodes
            made.append(out.count())
        return out

    monkeypatch.setattr(type(frame), "join", counted)
    assert dict(components(frame).collect()) == brute(links)
    assert sum(made) <= 3 * len(links)


def test_few_links_are_not_a_file_a_shuffle_partition(spark, monkeypatch):
    links, files, store = tangle(3), [], module.stored

    def counted(*args):
        out = store(*args)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(module, "stored", counted)
    frame = spark.createDataFrame(links, "a long, b long").coalesce(1)
    many = spark.sparkContext.defaultParallelism * 4
    conf = {"spark.sql.shuffle.partitions": str(many), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert dict(components(frame).collect()) == brute(links)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files and max(files) <= spark.sparkContext.defaultParallelism
