"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the package relies on; all are plain Spark options.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
ROCKSDB = SETTINGS["spark.sql.streaming.stateStore.providerClass"]


def local_session(
    cpus: int | str = 8, memory: str = "8g", app: str = "roadstate", extra: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in (SETTINGS | (extra or {})).items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="roadstate-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: Paths that this process has taken and not cleared.
_TAKEN: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, until ``clear_work``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _TAKEN.append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Remove what this process has written to paths of ``work_dir``; returns their number.

    Results are read from these paths when they are computed, so call it when the
    results of all queries so far have been used or stored elsewhere.
    """
    gone = 0
    while _TAKEN:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_TAKEN.pop())
        store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        gone += bool(store.delete(target, True))
    return gone
