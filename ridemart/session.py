"""Session settings for runs we start ourselves, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "ridemart") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIDEMART_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        # Do not look up the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession, purpose: str, root: str | None = None) -> str:
    """A new folder path under ``root``, by default the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, the benchmark) gets a temporary folder,
    one for the process, which goes when the process ends.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _local:
            _local.append(tempfile.TemporaryDirectory(prefix="ridemart-", ignore_cleanup_errors=True))
        root = _local[0].name
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
