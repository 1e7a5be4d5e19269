"""Session helpers for tests, the bench and the command-line plans.

Library operators never call these; they only receive DataFrames.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "rankloom", driver_memory: str = "16g") -> SparkSession:
    """A local session configured the way the library expects a cluster to be.

    AQE is on (partition coalescing and skew-join splitting), the UI is off, time
    is UTC.  ``shuffle_partitions`` defaults to the core count for local runs; on a
    cluster set it from the input size instead (~128 MB per shuffle partition).
    """
    parts = shuffle_partitions or (cpus if isinstance(cpus, int) else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is; without it we
    refuse to go on, as executors would write to disks the others cannot see.  Only a
    local master gets a scratch folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="rankloom-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "rankloom", name)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start high enough that each holds ~``target_partition_bytes``
    of input (AQE then coalesces small ones and splits skewed ones), and never
    below 3 waves of the cluster's cores; scans split parquet into ~256 MB tasks.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder under the configured ``spark.checkpoint.dir`` root that outlives the
    application (Spark adds a per-application subfolder for checkpoints), for
    artefacts reused across runs such as saved models.  Falls back to
    ``scratch_path`` when the setting is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        return scratch_path(spark, name)
    return os.path.join(root.rstrip("/"), "rankloom", name)
