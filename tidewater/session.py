"""Session helpers: a builder with scale-minded defaults and the shared
checkpoint folder.

Nothing here replaces Spark configuration; the builder only fills in values
the caller did not set, so a cluster's ``spark-defaults`` always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults applied only when the key is not already configured.
SCALE_DEFAULTS: dict[str, str] = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch a join to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Merge results are written by Spark's commit protocol; speculative
    # duplicates of a JDBC staging task would insert twice.
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
}


MB = 1024 * 1024
GB = 1024 * MB


def sizing_conf(
    input_bytes: int,
    total_cores: int,
    partition_bytes: int = 256 * MB,
    max_partitions: int | None = None,
) -> dict[str, str]:
    """Shuffle and scan sizes for a job reading ``input_bytes``.

    AQE can merge small shuffle partitions but never split an oversized one
    (except for skewed join sides), so the starting count must be high enough
    that each partition fits comfortably in an executor's memory: one partition
    per ``partition_bytes`` of input, at least two waves of the cluster's cores.
    For 100 TB on 8,000 cores that is ~400k; AQE then coalesces stages that shrink
    after filtering. ``max_partitions`` caps the count where a scheduler needs it.
    """
    if input_bytes < 0 or total_cores < 1:
        raise ValueError("input_bytes >= 0 and total_cores >= 1 required")
    wanted = -(-input_bytes // partition_bytes)
    n = int(max(wanted, 2 * total_cores))
    if max_partitions is not None:
        n = min(n, max_partitions)
    split = max(16 * MB, min(partition_bytes, input_bytes // max(1, 3 * total_cores)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def build_session(
    master: str | None = None,
    app_name: str = "tidewater",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
    time_zone: str | None = "UTC",
) -> SparkSession:
    """Create (or reuse) a session with the defaults above, where the cluster's own
    configuration (``spark-defaults``, ``spark-submit --conf``) does not name the key.
    What the caller asks for here is set in any case.

    Give ``input_bytes`` and ``total_cores`` to size shuffles and scan splits
    with ``sizing_conf``; ``shuffle_partitions`` overrides the shuffle count
    (locally, use about twice the core count). ``time_zone`` is the session
    zone that wall-clock filters on ``timestamp`` columns use; ``None`` keeps
    the cluster's setting.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    configured = SparkConf()
    conf = {k: v for k, v in SCALE_DEFAULTS.items() if not configured.contains(k)}
    if time_zone is not None:
        conf["spark.sql.session.timeZone"] = time_zone
    if input_bytes is not None and total_cores is not None:
        conf.update(sizing_conf(input_bytes, total_cores))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only in local mode, where there is no shared storage to name,
    is a private temporary folder created; on a cluster an unset value is an
    error rather than a silent machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
            "that every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewater-scratch/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, size: int = 4 * MB) -> None:
    """Rows go to Python workers in Arrow batches of about ``size`` bytes, where the
    session does not set that itself. Spark's own 64 MB (or 10,000 rows of any width)
    are held several times over by each running task: in the JVM's and Arrow's buffers
    and as Python objects. It stays set, since results are computed later."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(size))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
