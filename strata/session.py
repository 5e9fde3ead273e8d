"""Session helpers.

Queries never change the caller's session settings: every timestamp in the
lake is ``timestamp_ntz`` (wall-clock, as in the landing CSVs), so elapsed
times and date keys do not depend on ``spark.sql.session.timeZone``.

``build_session`` is for tests, the bench and command-line runs only; on a
cluster the job is handed the cluster's session.
"""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "strata",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root folder for everything a job writes (lake tables, landing files).

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is read
    from the session.  Where it is unset, only a local session, whose executor
    is the driver, gets a folder of its own; a cluster must name one.
    """
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except PySparkException:  # no SparkContext in a Spark Connect session
        pass
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = context._jvm.java.lang.System.getProperty("java.io.tmpdir")
        root = f"{own}/strata-{context.applicationId}"
        context.setCheckpointDir(root)
    return root.rstrip("/")


#: Bytes of Parquet input behind one shuffle partition.
PARTITION_BYTES = 4 << 20
#: Bytes of Parquet that one task reads, and of shuffled data that AQE merges into one task.
READ_BYTES = 16 << 20
MERGE_BYTES = 32 << 20
#: Settings for them, with Spark's defaults; a caller's own choice stays.
TASK_CONF = {
    "spark.sql.files.maxPartitionBytes": ("134217728b", READ_BYTES),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", MERGE_BYTES),
}


def stored_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of the files below ``paths`` (absent ones count nothing), from the file system's listing."""
    total = 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(folder):
            total += fs.getContentSummary(folder).getLength()
    return total


def scanned_bytes(frames: Iterable[DataFrame]) -> int:
    """Bytes of the tables and files that the plans of ``frames`` read, whole."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        total += sum(int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size()))
    return total


#: Removes a query's shuffle files when it ends, not when the driver's garbage collection meets them.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings whose queries leave no shuffle files, for jobs of many writes.

    A write's shuffle is of no use after it, but stays on the executors' disks
    until the driver collects garbage, which a driver with little to do hardly
    ever does.  The caller's session is not changed.
    """
    if spark.conf.get(TIDY, None) == "true":
        return spark
    own = _copy(spark)
    own.conf.set(TIDY, "true")
    return own


def _copy(spark: SparkSession) -> SparkSession:
    """A new session with the caller's settings."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value:
            try:
                own.conf.set(key, value)
            except PySparkException:  # a setting of the whole application
                continue
    return own


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session with the caller's settings whose tasks stay small however large the input is.

    AQE merges shuffle partitions but never adds any, and a task that reads
    well compressed Parquet sorts many times the bytes it reads: with fixed
    numbers both sorts grow with the input until they spill.  The caller's
    session is not changed, and is returned itself where its settings are enough.
    """
    name = "spark.sql.shuffle.partitions"
    needed = -(-input_bytes // PARTITION_BYTES)
    if needed <= int(spark.conf.get(name)) and input_bytes <= READ_BYTES:
        return spark
    own = _copy(spark)
    own.conf.set(name, str(max(needed, int(spark.conf.get(name)))))
    for key, (default, size) in TASK_CONF.items():
        if own.conf.get(key) == default:
            own.conf.set(key, str(size))
    return own


_RUN_DIRS: list[tuple[SparkSession, str]] = []


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder below the shared root for one run.

    Results read from it lazily, so it is removed when the driver ends.
    """
    path = f"{shared_root(spark)}/strata/{purpose}-{uuid.uuid4().hex[:12]}"
    if not _RUN_DIRS:
        atexit.register(_remove_run_dirs)
    _RUN_DIRS.append((spark, path))
    return path


def _remove_run_dirs() -> None:
    for spark, path in _RUN_DIRS:
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        except (Py4JError, OSError, AttributeError):  # the JVM has gone first; the folder stays
            return
