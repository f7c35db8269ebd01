"""Session construction and the shared scratch location.

Intermediate tables (round trips, stream sinks, lineage cuts) are written
under ``spark.checkpoint.dir``, the shared folder a cluster names for that
purpose.  Only a local session (tests) gets one made for it.
"""

from __future__ import annotations

import contextlib
import math
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "riskview",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE on, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Skip capturing the Python call site on every DataFrame/Column call
        # (several JVM round trips each); plans are built once per query and
        # errors still carry the failing expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Streaming state (the keys a feed has delivered) in RocksDB: off-heap
        # and on local disk, so it cannot exhaust executor heaps.
        # Takes effect for new checkpoints.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(shuffle_bytes: int, cores: int,
                           target_bytes: int = 256 << 20) -> int:
    """Initial shuffle partition count for a stage shuffling about
    ``shuffle_bytes``: no partition above ``target_bytes`` before AQE
    coalesces small ones, and at least two waves of ``cores`` tasks."""
    return max(2 * cores, math.ceil(shuffle_bytes / target_bytes))


def size_shuffles(spark: SparkSession, shuffle_bytes: int,
                  target_bytes: int = 256 << 20) -> int:
    """Size shuffles for the data at hand (e.g. 80k partitions for 20 TB
    shuffled at 256 MB each).  AQE starts from that many partitions and
    coalesces towards ``target_bytes``, so a small day is not split into
    tiny tasks and a large one has no partition that cannot fit executor
    memory.  Estimate ``shuffle_bytes`` after projection and map-side
    aggregation, not from the raw input size."""
    cores = spark.sparkContext.defaultParallelism
    n = shuffle_partitions_for(shuffle_bytes, cores, target_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.  Without one, a local session
    makes a temporary folder; any other raises, because its executors could
    not see a folder of the driver's machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskview-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


_scopes = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the checkpoint folder."""
    path = f"{checkpoint_root(spark)}/riskview-{name}-{uuid.uuid4().hex[:12]}"
    for scope in getattr(_scopes, "open", [])[-1:]:
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch directories that this thread asked for inside the
    ``with`` block when it ends: for steps that publish what they compute."""
    _scopes.open = [*getattr(_scopes, "open", []), []]
    try:
        yield
    finally:
        *_scopes.open, own = _scopes.open
        jvm = spark.sparkContext._jvm
        for p in own:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
