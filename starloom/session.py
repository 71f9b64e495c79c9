"""Session factory and shared-storage helpers.

One place decides the configuration every job relies on: AQE on (runtime
re-planning, partition coalescing, skew-join splitting), UTC session time
zone (inputs are TIMESTAMP_NTZ), no UI server, Arrow for pandas hand-off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoint files are removed once their frames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a run over ``input_bytes`` of (compressed) input
    on ``total_cores`` cores: shuffle partitions so that one partition is
    about ``target_partition_bytes`` (at least two waves of tasks), input
    splits of the same size, and AQE's coalescing target to match.
    E.g. 100 TB on 1000 executors × 8 cores → ~400k partitions."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_session(master: str | None = None, app: str = "starloom",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, input_bytes: int | None = None,
                total_cores: int | None = None, shared_dir: str | None = None) -> SparkSession:
    """Build (or reuse) the session. ``master`` is only set for local runs;
    on a cluster the launcher decides.  ``shared_dir`` names the folder for
    checkpoints and scratch tables where ``spark.checkpoint.dir`` is not set
    by the launcher.  ``input_bytes``/``total_cores`` size
    the partitions with ``scale_conf``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_BASE_CONF)
    if input_bytes and total_cores:
        conf.update(scale_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if shared_dir:
        conf["spark.checkpoint.dir"] = shared_dir
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM on one machine (``local``, ``local[n]``; not ``local-cluster``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Taken from ``spark.checkpoint.dir`` when the cluster names one.  Only a
    local session (tests, laptop) may fall back to a fresh temp folder; on a
    cluster a machine-local folder would vanish with its executor, so we fail.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="starloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder under the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
