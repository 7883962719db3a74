"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName("pageloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without it; a machine-local folder on a cluster
    would be lost with its executor.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="pageloom-")
    return _local_root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder if nothing is set yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
