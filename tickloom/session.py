"""Session settings and the few facts the jobs read back from a session."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def get_session(
    app_name: str = "tickloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session in UTC with adaptive execution.

    ``master`` stays unset by default so that ``spark-submit`` decides where the job runs.
    ``shuffle_partitions`` is the number AQE starts from and coalesces down; see
    :func:`shuffle_partitions_for`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Call-site capture costs several driver round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(extra or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffled_bytes: int, cores: int) -> int:
    """Shuffle partitions of about 128 MB each, in whole waves over ``cores``."""
    wanted = max(1, math.ceil(shuffled_bytes / TARGET_PARTITION_BYTES))
    return math.ceil(wanted / cores) * cores


def shared_dir(spark: SparkSession) -> str | None:
    """The folder all executors reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/") if configured else None


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one all executors reach.

    Only a local master, whose executors share the driver's disk, may go without a named one.
    """
    shared = shared_dir(spark)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        shared = tempfile.mkdtemp(prefix="tickloom-shared-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the actions inside, set back afterwards."""
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (or anything a glob names) exists on its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0
