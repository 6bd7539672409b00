"""Session construction and the shared working folder.

Everything the library writes between stages (staged micro-batches, keyed
tables created by the demo queries, stream checkpoints) goes below the folder
the cluster names in ``spark.checkpoint.dir``.  Only when that is unset (local
runs, tests) do we pick a local temporary folder and register it; on a cluster
that is an error, as executors do not share the driver's disk.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark.sources.files import FileSystem


# State lives off-heap in RocksDB; each batch uploads a changelog and
# snapshots are taken periodically, so commits stay cheap as state grows.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tidemark",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    AQE stays on so partition counts are re-planned from runtime sizes and
    skewed join partitions are split; the session time zone is UTC because
    the history tables store zone-less timestamps that we treat as UTC.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **ROCKSDB_STATE,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def _set_for_now(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with ``settings``; behind the block it has its own again."""
    own = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in own.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action in this block go when it ends, and not when the driver collects its garbage."""
    with _set_for_now(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started in this block keep their state in RocksDB where the session names no provider of its own.

    A stream copies the settings when it starts, so the session has its own again after the block.
    Spark's default provider holds one table per operator, ``transformWithState`` needs several.
    """
    own = spark.conf.get(_PROVIDER, None)
    if own and not own.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    with _set_for_now(spark, ROCKSDB_STATE):
        yield


def _checkpoint_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is not set: on {master} it must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    base = _checkpoint_base(spark)
    tail = list(parts) + ([uuid.uuid4().hex] if unique else [])
    path = posixpath.join(base, "tidemark", *tail)
    FileSystem(spark, path).mkdirs(path)
    return path
