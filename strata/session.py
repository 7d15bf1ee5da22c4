"""Session helpers for local runs (tests, bench) and the shared scratch folder.

On a cluster the session comes from the platform; the library never builds
one itself.  ``scratch_dir`` is where jobs write intermediate tables: the
shared folder named by ``spark.checkpoint.dir``.  Only when that setting is
absent (local tests) do we create one.  ``release_scratch`` drops what a
session has stored there, ``release_folder`` one folder before the rest;
``shuffles_dropped`` is for the executors' own disks.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", driver_memory: str = "8g") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


# Whether executors and driver see each other's files, by application and folder.
_SHARED: dict[tuple[str, str], bool] = {}


def _is_shared(spark: SparkSession, base: str) -> bool:
    """Whether what the executors write under ``base`` reaches the driver and the other executors.

    Found out once an application by a small write, read again: rows that a
    machine keeps on its own disk are missing then, or the commit fails.
    """
    known = (spark.sparkContext.applicationId, base)
    if known not in _SHARED:
        path = f"{base}/shared-{uuid.uuid4().hex[:12]}"
        try:
            n = 2 * spark.sparkContext.defaultParallelism
            _remember(spark, "folder", path)
            spark.range(0, n, 1, n).write.parquet(path)
            _SHARED[known] = spark.read.schema("id long").parquet(path).count() == n
        except Exception:  # whatever it is, the folder cannot be used
            _SHARED[known] = False
    return _SHARED[known]


def _shared_base(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the context's; a local session without either gets its own.

    ``spark.checkpoint.dir`` is a setting of the context, so it is never set
    here.  A path without a scheme means the default file system; off local
    mode that may be a disk of the machine's own or a shared one mounted
    there, so it is tried out (``_is_shared``).
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder on the cluster's "
                "shared file system before running jobs that store intermediate layers")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
        base = context.getCheckpointDir()
    elif "://" not in base and not base.startswith("file:") and not _is_local(spark):
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        if default.startswith("file:") and not _is_shared(spark, base.rstrip("/")):
            raise RuntimeError(
                f"spark.checkpoint.dir {base!r} names no file system, and what executors write to "
                "the machine's disk there does not reach the driver: give a shared folder")
    return base.rstrip("/")


# What this process stored per application, so that it can be dropped again.
_STORED: dict[str, list[tuple[str, str]]] = {}


def _remember(spark: SparkSession, kind: str, name: str) -> None:
    _STORED.setdefault(spark.sparkContext.applicationId, []).append((kind, name))


def scratch_dir(spark: SparkSession, purpose: str = "scratch") -> str:
    """A fresh sub-folder's path under the shared folder; ``release_scratch`` drops it."""
    path = f"{_shared_base(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    _remember(spark, "folder", path)
    return path


def scratch_schema(spark: SparkSession, name: str) -> None:
    """Marks a catalogue schema (``catalog.schema``) as temporary: ``release_scratch`` drops it with its tables."""
    _remember(spark, "schema", name)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_folder(spark: SparkSession, folder: str) -> None:
    """Drops one scratch folder that nothing reads any more, before the application's others."""
    _delete(spark, folder)
    stored = _STORED.get(spark.sparkContext.applicationId, [])
    if ("folder", folder) in stored:
        stored.remove(("folder", folder))


def release_scratch(spark: SparkSession) -> int:
    """Drops every scratch folder and schema of this application; returns how many.

    A frame that reads from them is lazy, so the caller says when its results
    are consumed.  Names that are already gone are skipped.
    """
    stored = _STORED.pop(spark.sparkContext.applicationId, [])
    for kind, name in reversed(stored):
        if kind == "schema":
            spark.sql(f"DROP NAMESPACE IF EXISTS {name} CASCADE")
            continue
        _delete(spark, name)
    return len(stored)


#: Whether Spark drops an execution's shuffle files when it ends (a session setting of Spark 4.1; older ones ignore it).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes of frames inside drop their shuffle files as they end.

    Otherwise these stay on the executors' disks until the driver happens to
    collect garbage, so a run that stores several layers holds the shuffles of
    all of them at once.  What a write has stored is read from there; its
    shuffle files serve nobody.  The session's own setting is put back.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def scale_conf(shuffle_bytes: int, cores: int, target_partition_bytes: int = 128 << 20,
               max_partitions: int | None = None) -> dict[str, str]:
    """Settings sized for a job that shuffles about ``shuffle_bytes``.

    The initial shuffle partition count keeps each partition near
    ``target_partition_bytes`` (so sorts and hash maps fit in task memory and
    spill rarely), never below three tasks per core.  AQE then coalesces small
    partitions and splits skewed ones, also where the split needs an extra
    shuffle.  Example: 30 TB shuffled on 8,000 cores -> 223,518 partitions.

    There is no cap unless the caller sets one: with ``max_partitions`` the
    partitions of a larger job grow beyond the target (and spill), in return
    for fewer shuffle blocks (map tasks x partitions) and fetch requests.
    """
    parts = max(3 * cores, -(-shuffle_bytes // target_partition_bytes))
    if max_partitions is not None:
        parts = min(parts, max_partitions)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even when that costs an extra shuffle: gold
        # groups by Customer_ID, so without this AQE keeps the customer
        # join's partitions for the aggregation and leaves a hot customer
        # in one task.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * target_partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
