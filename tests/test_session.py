"""Shuffle sizing and the shared scratch folder."""

from riskview.session import scratch_path, shuffle_partitions_for, size_shuffles


def test_shuffle_partitions_for_scale():
    mb = 1 << 20
    assert shuffle_partitions_for(0, cores=8) == 16                   # two waves minimum
    assert shuffle_partitions_for(20 << 40, cores=8) == 20 * (1 << 40) // (256 * mb)
    assert shuffle_partitions_for(1000 * mb, cores=8, target_bytes=100 * mb) == 16
    assert shuffle_partitions_for(1001 * mb, cores=1, target_bytes=100 * mb) == 11


def test_size_shuffles_sets_initial_and_advisory(spark):
    keys = ("spark.sql.shuffle.partitions",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        n = size_shuffles(spark, 64 << 30)          # 64 GB at 256 MB
        assert n == 256
        assert [spark.conf.get(k) for k in keys] == ["256", "256", str(256 << 20)]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    root = spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))


def test_a_cluster_without_a_shared_folder_raises(spark, monkeypatch):
    import pytest

    from riskview import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_scratch_of_a_scope_is_removed(spark):
    import os

    from riskview.session import scratch_scope
    local = lambda p: p.split("file:", 1)[-1]
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        spark.range(3).write.parquet(inner)
        assert os.path.isdir(local(inner))
    outer = scratch_path(spark, "outer")
    spark.range(3).write.parquet(outer)
    assert not os.path.exists(local(inner)) and os.path.isdir(local(outer))
