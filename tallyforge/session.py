"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime sizes decide the join strategy: nothing is hinted, so a side is broadcast only when its
# measured size is below the threshold.  A skewed sort-merge partition is split, even where that
# costs another shuffle.  Column call sites are not recorded: each costs round trips to the JVM.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_dirs: list[tempfile.TemporaryDirectory] = []


def build_session(app_name: str = "tallyforge", **overrides: str) -> SparkSession:
    """Create a session with the engine defaults; keyword arguments override them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Each query run inside removes its shuffle files as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of all steps of a load
    would lie on disk at once.
    """
    with _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def many_folders(spark: SparkSession):
    """Folders listed inside are dealt to a few tasks a core; else each is a task, up to 10,000."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    with _held(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks)):
        yield


@contextmanager
def _held(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path for written intermediates.

    A cluster names its shared folder in ``spark.checkpoint.dir``.  Only when that is unset, as in
    local tests, is a machine-local folder used; it is removed when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="tallyforge-"))
        shared = _local_dirs[-1].name
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
