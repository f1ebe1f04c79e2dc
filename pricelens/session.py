"""Session helpers: one place for the settings the pipelines rely on.

Nothing here is required by the library functions; a caller that brings its own
session keeps its settings. ``scratch_dir`` is the only function the library
itself uses, for intermediate tables that must live on shared storage.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for the flatten and write pipelines. AQE re-plans joins from runtime
# sizes, splits skewed join partitions, and lets `rebalance` split a hot
# billing code into several write tasks.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Partition values such as billing_code `00100` stay strings on path reads.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Bucket filters on npi / negotiated_type prune files (SelectedBucketsCount).
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pricelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]):
    """The session with these settings, and with its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# A task that writes to up to this many folders keeps a file open in each, so it need not sort its
# rows by folder, which spills where few rows are read and many wide ones written. Beyond, Spark sorts.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "64"}


def listing(spark: SparkSession):
    """Folders are listed by a few tasks for each core; Spark's own way is a task for each folder."""
    return session_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)})


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage. Only when it is unset
    (a test, a laptop) do we pick a fresh local folder and record it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to storage that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one intermediate table."""
    return f"{checkpoint_root(spark)}/pricelens/{name}-{uuid.uuid4().hex[:12]}"
