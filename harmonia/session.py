"""Session construction and shared scratch locations.

Operators never read session state; only the helpers here do.  Scratch output always goes
below the folder the cluster names in ``spark.checkpoint.dir`` so that every executor sees it.
A folder of our own is set only when the session has none and runs in one process (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "harmonia", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder from ``spark.checkpoint.dir``; on ``local[...]`` one is set if it is unset."""
    base = None
    try:
        base = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup failure
        base = None
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the session conf is all there is
        pass
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if sc is None or sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="harmonia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the shared folder."""
    return f"{shared_dir(spark)}/harmonia/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partitioning settings for a cluster run, from the input volume and the core count.

    Scans split into ~``target`` splits; the initial shuffle partition count is high enough that
    no post-shuffle partition of the widest stage (a full-row dedup of the input) exceeds the
    target, and AQE coalesces small ones back down and splits skewed ones.  For 100 TB on 8000
    cores this gives ~400k scan tasks and ~400k initial shuffle partitions, which
    coalesce at run time.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
