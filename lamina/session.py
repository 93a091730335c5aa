"""Session construction and the shared working folder.

On a cluster the working folder is the one named by ``spark.checkpoint.dir``
(a shared file system every executor can reach). Only when it is unset, as in
local tests, a fresh local folder is made and registered as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_ROOT: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lamina", memory: str = "8g") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")     # concurrent fits share the cores
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # catalog tables of local runs live under /tmp, not in the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lamina-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, sinks and stream checkpoints."""
    global _FALLBACK_ROOT
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _FALLBACK_ROOT is None:
        # Unset only in local runs (tests): make our own and register it.
        _FALLBACK_ROOT = tempfile.mkdtemp(prefix="lamina-ckpt-")
    sc.setCheckpointDir(_FALLBACK_ROOT)
    return (sc.getCheckpointDir() or _FALLBACK_ROOT).rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused, never wiped)."""
    return f"{checkpoint_root(spark)}/lamina/{name}-{uuid.uuid4().hex[:12]}"


def collect_garbage(spark: SparkSession) -> None:
    """Let go of what finished work has left: Spark removes shuffle files, broadcasts and caches
    when the driver's JVM collects its garbage, which it may put off until its heap is full."""
    spark.sparkContext._jvm.System.gc()
