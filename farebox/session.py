"""Session construction and shared-storage helpers.

Everything that needs durable scratch space (stream checkpoints, upsert
sink versions, lineage cuts) goes under the folder the cluster names in
``spark.checkpoint.dir``.  A private folder under ``/tmp`` is only made
when that setting is absent *and* the master is local (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Session defaults the package relies on: UTC wall clock, ANSI SQL, AQE with
# skew-join splitting and partition coalescing, no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: float, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Partition sizing for a given input volume and cluster.

    Shuffle partitions are chosen so that one partition of the largest shuffle
    (assumed no bigger than the input) is about ``target_partition_bytes``,
    rounded up to whole waves of the cluster's task slots; AQE then coalesces
    small ones and splits skewed ones.  Input splits use the same size.
    Example: 100 TiB on 1000 executors x 8 cores -> 416 000 shuffle partitions
    (52 waves of 8000 slots), 256 MiB splits.
    """
    slots = max(1, executors * cores_per_executor)
    parts = max(slots, int(input_bytes // target_partition_bytes) + 1)
    parts = ((parts + slots - 1) // slots) * slots
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(4 * target_partition_bytes),
    }


def get_spark(master: str | None = None, app: str = "farebox",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001  remote session: treat as a cluster
        return False


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written tables, shared by all executors.

    Read from ``spark.checkpoint.dir`` (or a checkpoint dir already set on
    the context).  Only a local session without that setting gets a fresh
    private folder, which is then registered as its checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        have = sc.getCheckpointDir()
        if have:
            return have.rstrip("/")
        d = sc.getConf().get("spark.checkpoint.dir", None) or d
        if d:
            sc.setCheckpointDir(d)  # so DataFrame.checkpoint() writes there too
    except Exception:  # noqa: BLE001  remote session: only the SQL conf is visible
        pass
    if d:
        return (sc.getCheckpointDir() if sc is not None and sc.getCheckpointDir() else d).rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared "
            "folder for checkpoints and intermediate tables")
    d = tempfile.mkdtemp(prefix="farebox-ckpt-", dir="/tmp")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local one).

    Survives executor loss: the data lives in the shared file system, not in
    executor block managers.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def at_once(spark: SparkSession, steps: Sequence[Callable]) -> list:
    """Results of steps that do not depend on each other, each run in a thread of its own with
    the caller's local properties; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        # wrapped for each step: the properties are copied when the target is made
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def local_file_uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)
