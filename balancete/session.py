"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# partitions at run time, skew-join splits hot partitions. Broadcasts come
# only from sizes that are known, never from static file-size estimates: the
# sides our code checks (operators.lookups.checked) carry an explicit hint,
# and AQE may still broadcast a side whose *measured* shuffle output is small.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # A month's headers select few of a fact's rows: a Bloom filter of their keys is applied to
    # any fact scan of 1 GB or more before its exchange. The bound on the filter's own side is on
    # the size of the header before its date filter (which reaches the scan); the filter has at
    # most 1 MB whatever that size.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "20GB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of DataFrames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "balancete", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster the master and partition counts come from spark-submit; the
    arguments here are for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that folder is set by the operator (a shared filesystem every
    executor can reach) and is only read here; without it this raises, since a
    folder of one machine would be missing on the others. With a local master
    (tests) a scratch folder is made, and removed when Python exits.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = _LOCAL_FALLBACK.get(sc.applicationId)
        if not base:
            base = _LOCAL_FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="balancete-ckpt-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def remove_shared(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_scratch_path`` (on whatever file system it is)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def local_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"


def checkpoint(df):
    """Eager ``DataFrame.checkpoint`` into the shared checkpoint folder.

    Works with any session (for instance one built by a scheduler without
    ``get_spark``): the folder named by ``spark.checkpoint.dir`` is used, and
    only when none is configured is a local one chosen (tests).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
