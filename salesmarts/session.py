"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The joins and aggregations rely on the adaptive planner: it merges small shuffle
# partitions, splits hot ones in sort-merge joins and turns a join into a broadcast
# only after it has measured the side. forceOptimizeSkewedJoin lets it split a hot key
# even where that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # An overflowing sum of cents must raise an error, not wrap around.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every column expression more than doubles the calls to
    # the JVM while a plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# The driver tracks one block per map task and reducer, so neither may grow with the input
# without end: beyond these counts the tasks get larger instead, and sort and spill.
MAX_SCAN_TASKS = 200_000
MAX_REDUCERS = 50_000


def sized(
    input_bytes: int, cores: int = 8, max_scan_tasks: int = MAX_SCAN_TASKS, max_reducers: int = MAX_REDUCERS
) -> dict[str, str]:
    """Scan split and shuffle partitions for an input of ``input_bytes``.

    Tasks of 128 MB of input and reducers of about 256 MB while the two limits allow it; beyond,
    tasks get larger. Columns are pruned before any shuffle, so reducers see well under their
    share of the input. Results do not depend on any of it.
    """
    split = max(128 << 20, math.ceil(input_bytes / max_scan_tasks))
    reducers = min(max(cores, math.ceil(input_bytes / (256 << 20))), max_reducers)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(reducers),
    }


def configure(
    builder: SparkSession.Builder, input_bytes: int | None = None, **limits: int
) -> SparkSession.Builder:
    """The settings, with task sizes for ``input_bytes``; ``limits`` are those of ``sized``."""
    settings = dict(SETTINGS)
    if input_bytes is not None:
        settings |= sized(input_bytes, **limits)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder


def _file_system(spark: SparkSession, path: str):
    """Hadoop's handle of a path and the file system that holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is not there."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written intermediate, in the folder the cluster shares.

    That is ``spark.checkpoint.dir``, or the warehouse where it is unset. Whatever is written
    there and not deleted before goes when the application ends. On a cluster neither may be a
    folder of one machine's own: its executors would write to different disks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    told = bool(shared)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    place, files = _file_system(spark, shared)
    if not told and files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {shared} is this machine's own")
    folder = f"{shared.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    place, files = _file_system(spark, folder)
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch path whose contents are deleted when the block ends."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        delete(spark, path)
