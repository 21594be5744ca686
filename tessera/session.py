"""Session and shared-scratch helpers.

Scratch data (ingest round trips, lineage cuts) always goes under the folder the
cluster names in ``spark.checkpoint.dir``; a private folder is only created when
that setting is absent, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", driver_memory: str = "8g") -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one is made only where it is unset and Spark runs locally."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; it goes when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.getParent())
    fs.deleteOnExit(hadoop)
    return path


class Intermediates:
    """A folder under the shared checkpoint folder for what jobs write along the way, deleted when its last user lets go.

    While it is open (see :func:`intermediates`), checkpoints and scratch tables go there.  A result that reads them later keeps the
    folder with :meth:`retain` until its :meth:`release`.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{_root(spark)}/tessera-intermediates-{uuid.uuid4().hex[:12]}"
        self.users = 1

    def retain(self) -> "Intermediates":
        if not self.users:
            raise ValueError("the intermediates are deleted already")
        self.users += 1
        return self

    def release(self) -> None:
        if not self.users:
            return
        self.users -= 1
        if not self.users:
            hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _set_folder(spark: SparkSession) -> str:
    """The checkpoint folder as it was set: Spark makes one of its own below it."""
    return ensure_checkpoint_dir(spark).rstrip("/").rpartition("/")[0]


def _root(spark: SparkSession) -> str:
    """The checkpoint folder outside all open :class:`Intermediates`."""
    return _set_folder(spark).split("/tessera-intermediates-")[0]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[Intermediates]:
    """Whatever jobs write inside the block is deleted at its end, unless a result still holds it (``retain``).

    DataFrames made in the block read those files: act on them inside, or retain.  Blocks may be nested.
    """
    outer = _set_folder(spark)
    own = Intermediates(spark)
    spark.sparkContext.setCheckpointDir(own.path)
    try:
        yield own
    finally:
        spark.sparkContext.setCheckpointDir(outer)
        own.release()
