"""Shared storage for intermediate tables.

Fitted state and engineered tables are written once to the folder that the
session names in ``spark.checkpoint.dir`` and read back. The written files, not
the executors, then own the data: a lost executor costs a re-read, lineage stays
short, and the planner sees real sizes when it decides whether to broadcast.
"""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


#: With this set Spark deletes the shuffle files of a query when it ends, not when the driver next collects its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, tempfile.TemporaryDirectory] = {}
_own_dirs_lock = threading.Lock()
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per application: their Python may not have it on its path."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="gavelcast-code-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/gavelcast", "zip", root, "gavelcast"))
        _shipped.add(application)


def shared_dir(spark: SparkSession) -> str:
    """Folder reachable by every executor, as configured in the session.

    Without a setting a local session gets a temporary folder of its own, which goes when
    Python ends; a cluster has to name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    with _own_dirs_lock:
        if application not in _own_dirs:
            _own_dirs[application] = tempfile.TemporaryDirectory(
                prefix="gavelcast-", ignore_cleanup_errors=True)
        return _own_dirs[application].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below one folder per application, so that folder can go when it ends."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/gavelcast/{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder: a fresh scan of it, and its path for ``discard``."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written_clean(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``written``, and the shuffle files of that go at once. For steps that run one after the other."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_SHUFFLES, "false")
    conf.set(CLEAN_SHUFFLES, "true")
    try:
        return written(df, label)
    finally:
        conf.set(CLEAN_SHUFFLES, before)


def materialize_clean(df: DataFrame, label: str) -> DataFrame:
    """``written_clean`` of a table that stays."""
    return written_clean(df, label)[0]


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a fresh scan of it."""
    return written(df, label, partition_by)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table below this application's scratch folder that nothing reads any more.

    Spark's own file system does it, so the folder may be on any store the executors share.
    """
    own = scratch_root(spark)
    if not path.startswith(f"{own}/"):
        raise ValueError(f"{path} is not below {own}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder, if no folder is set for that yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def spread(df: DataFrame) -> DataFrame:
    """Use every core when a scan yields fewer splits than there are cores.

    One large row group would otherwise keep all later per-row work in one task.
    Inputs with enough splits, that is all large ones, pass through unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def concurrently(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent fits at the same time, so one fills the cores another leaves idle."""
    with ThreadPoolExecutor(max_workers=max(len(steps), 1)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [s.result() for s in started]
