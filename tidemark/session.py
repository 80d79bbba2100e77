"""Session construction and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.driver.memory": "12g",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs. On a cluster use spark-submit settings."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when nothing is configured and the master is local
    (tests, local runs) a private folder is created and registered. On a cluster
    an unset folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # the context appends a per-application uuid; keep our folders beside it
        return root.rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: stage tables, state and "
                               "stream checkpoints must survive the loss of any machine")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")   # local mode only (tests, laptops)
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/tidemark/{purpose}-{uuid.uuid4().hex[:12]}"


SPLIT_KEY, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 32 << 20


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Tasks that read files get at most ``SPLIT_BYTES`` of them. JSON text in zstd holds about ten times its size, so
    sorting what a task makes of the default 128 MB would spill."""
    before = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(SPLIT_KEY, str(min(before, SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_KEY, str(before))


FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Writes in small splits whose shuffle files are deleted when the write ends. Else they stay until the driver
    happens to collect the garbage, and a batch of many writes holds the shuffles of all of them at once."""
    before = spark.conf.get(FREE_KEY, "false")
    spark.conf.set(FREE_KEY, "true")
    try:
        with small_splits(spark):
            yield
    finally:
        spark.conf.set(FREE_KEY, before)
