"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

#: Runtime settings every job needs.  All of them may be set on a live session.
RUNTIME_CONF = {
    # the day of an article is its UTC day
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # windows cost far more than their bytes suggest: let small stages keep their parallelism
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("newstape")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def own_folder() -> str:
    """A new folder of this machine, removed when the program ends; for local sessions only."""
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp" if os.path.isdir("/tmp") else None)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def work_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables and stream checkpoints: ``spark.checkpoint.dir``, which all executors share.

    A local session that has not set it gets a folder of its own; a cluster must set it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = own_folder()
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package; on a cluster it comes with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the work folder that nobody else writes to."""
    return f"{work_folder(spark)}/newstape/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not when the driver next collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_reads(spark: SparkSession, most: int = 16 << 20, rows: int = 512) -> Iterator[None]:
    """Actions in here read files in pieces of ``most`` bytes and batches of ``rows`` rows at most.

    What compresses well, or has long rows, is far larger in a task's memory than in its file.
    """
    limits = {"spark.sql.files.maxPartitionBytes": most, "spark.sql.parquet.columnarReaderBatchSize": rows}
    held = {key: spark.conf.get(key) for key in limits}
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, limit in limits.items():
        spark.conf.set(key, str(min(size(held[key]), limit)))
    try:
        yield
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
