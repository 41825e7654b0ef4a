"""Session settings and the shared scratch location.

Library code never sets ``master``; that belongs to spark-submit. ``local_session``
exists only for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on; applied by ``configure`` on an existing session
# (only the SQL ones can change at runtime).
JOB_CONF = {
    # Day buckets are computed from UTC wall-clock time.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn a sort-merge join into a broadcast only when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # Broadcasts happen only below this measured size (static stats and AQE).
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


#: Input bytes (Parquet) behind one shuffle partition: about 300,000 line items.
BYTES_A_PARTITION = 8 << 20


def input_parts(spark: SparkSession, path: str) -> int:
    """In how many parts an input is dealt so that a part stays as long when the input grows; one listing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return max(1, -(-size // BYTES_A_PARTITION))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    It is read from the session. Only when it is unset (local tests) is a fresh
    folder created and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir")
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            d = None
    if not d:
        existing = sc.getCheckpointDir()
        if existing:
            return existing
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
        # local mode only (tests, bench): one JVM, so a local folder is shared by every task
        d = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused; ``drop`` clears it, else it stays)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path that is dropped at the end of the block; what reads it has to be written by then."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        drop(spark, path)


#: Shuffle files go when their query has ended; else they stay until the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """In this block a query's shuffle files are dropped as it ends: a job of many writes needs the disk of the largest."""
    was = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if was is None else spark.conf.set(DROP_SHUFFLES, was)
