"""Session and shared-folder helpers.

Library functions never build their own session; they take the caller's.
``local_session`` exists for tests, the bench and small local runs.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings for a cluster run of the pipelines (pass to the session builder).
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming window state in RocksDB, with incremental changelog checkpoints.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Arrow batches for the protobuf decode.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "packetflow", extra: dict | None = None) -> SparkSession:
    """A local session set up the way the pipelines expect (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a machine-local folder would not survive
    the loss of an executor or be visible to others). Only a local-mode
    session without one gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _one_machine(sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="packetflow-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def _one_machine(master: str) -> bool:
    """Whether driver and executors are one process (`local-cluster` has executors of its own)."""
    return master == "local" or master.startswith("local[")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder for one run."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make `packetflow` importable in the application's Python workers.

    Python steps (decode, webhook) are unpickled on executors by importing this
    package. A zip of it is always added with `addPyFile`, once per
    application, whether or not it is installed there; Spark serves it to every
    executor. Outside local mode the
    zip is first copied to the shared checkpoint folder.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        root = os.path.dirname(os.path.abspath(__file__))
        fd, path = tempfile.mkstemp(prefix="packetflow-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
            for folder, _, files in os.walk(root):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        zf.write(full, os.path.relpath(full, os.path.dirname(root)))
        if not _one_machine(sc.master):
            # On a cluster, serve it from the shared folder, not a driver-local one.
            path = copy_to_shared(spark, path, f"pyfiles/{app}/packetflow.zip")
        sc.addPyFile(path)
        _SHIPPED.add(app)


def copy_to_shared(spark: SparkSession, local_path: str, name: str) -> str:
    """Move a driver-local file to `<checkpoint folder>/<name>`; returns its path."""
    sc = spark.sparkContext
    jvm = sc._jvm
    shared = f"{checkpoint_root(spark)}/{name}"
    dst = jvm.org.apache.hadoop.fs.Path(shared)
    fs = dst.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.copyFromLocalFile(True, True, jvm.org.apache.hadoop.fs.Path(local_path), dst)
    return shared
