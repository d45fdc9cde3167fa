"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A repeated field keeps its last value, as in typed decoding.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a running session."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession, n: int) -> AbstractContextManager[None]:
    """Run something with ``n`` shuffle partitions."""
    return _setting(spark, "spark.sql.shuffle.partitions", n)


def batch_rows(spark: SparkSession, n: int) -> AbstractContextManager[None]:
    """Run something with at most ``n`` rows in a batch that a Python worker gets; a worker and the JVM each hold one or two."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", n)


_local: dict[str, str] = {}


def _local_root(spark: SparkSession) -> str:
    """A folder of this machine, for sessions that run on it alone; removed when Python ends."""
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="docstream-")
        atexit.register(shutil.rmtree, _local[application], ignore_errors=True)
    return _local[application]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A path that does not exist yet under ``spark.checkpoint.dir``; its content goes when the JVM ends.

    Where that is unset, a local folder; on a cluster it has to be set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = f"{(shared or _local_root(spark)).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{path}/data"
