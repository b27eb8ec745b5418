"""Session defaults and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
only ever choose one ourselves in local mode (tests, the bench), where no shared
file system exists.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # interval shuffles are small but feed day expansions ~50x larger: small partitions keep every core busy
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "holdwise") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="holdwise-warehouse-"))
        .config("spark.driver.memory", os.environ.get("HOLDWISE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_time_zone(spark: SparkSession) -> None:
    """Decision D7: timestamp-to-date casts must not depend on the host zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: HotSpot never compiles a method of more bytecode; Spark's default is 65,535.
COMPILED_BYTES = 8000
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


WHOLE_STAGE = "spark.sql.codegen.wholeStage"


@contextmanager
def _held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def compiled_methods(spark: SparkSession):
    """For a job run inside: stages whose fused code HotSpot would only interpret run operator by operator, each compiled."""
    return _held(spark, HUGE_METHOD, str(COMPILED_BYTES))


def unfused_stages(spark: SparkSession):
    """For many jobs run inside: the driver generates and compiles no fused code for each of their stages, which costs it memory."""
    return _held(spark, WHOLE_STAGE, "false")


#: Otherwise shuffle files stay until the driver happens to collect its garbage.
RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released_shuffles(spark: SparkSession):
    """For a write run inside: its shuffle files go when it ends."""
    return _held(spark, RELEASED, "true")


#: With writers to spare, rows go to their files as they come; Spark would sort them by file first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def kept_order(spark: SparkSession):
    """For a write into buckets run inside, each task of which fills one bucket: rows keep their order."""
    return _held(spark, WRITERS, "2")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediate tables.

    Read from the session. Only in local mode, when nothing is configured, a
    fresh folder under /tmp is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="holdwise-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused between runs)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
