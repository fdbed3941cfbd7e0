"""Session settings the operators are designed for."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session somebody else made.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot employee, date or word is split by the skew-join rule even when the
    # split costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # group by (emp, date) must not reuse a partitioning by emp alone: that would
    # put every date of a hot employee into one task.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # A table of many parts is listed by so many tasks, not by one for each part.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = "*", memory: str = "8g", app: str = "rosterline", shared: str | None = None
) -> SparkSession:
    """A local session for tests and benchmarks; shared becomes spark.checkpoint.dir."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Where the setting is missing, a local session gets a new temporary folder;
    a cluster session is refused, since executors could not see one.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="rosterline-")


# Folders this process has written tables of steps to.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    _SCRATCH.append(f"{shared_dir(spark)}/rosterline-{os.getpid()}-{uuid.uuid4().hex[:12]}")
    return f"{_SCRATCH[-1]}/{name}"


def clear_scratch(spark: SparkSession) -> int:
    """Remove the tables of steps that this process has written, once their results are stored; how many."""
    from .sources.files import remove

    folders = [_SCRATCH.pop() for _ in range(len(_SCRATCH))]
    for folder in folders:
        remove(spark, folder)
    return len(folders)
